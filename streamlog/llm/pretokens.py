"""Tokenizing by distinct pre-tokens: each distinct piece of text is encoded once by the tokenizer, then looked up.

Texts are cut, in Arrow, where the tokenizer can't look across: at white space and between a letter and a stop. What a piece encodes to is then the same
wherever it stands, so the ids of a text are those of its pieces in order. Tokenizers of other kinds encode texts whole.
A piece of plain letters goes straight to the tokenizer's model, in the byte alphabet; any other through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces that a worker remembers at most, the characters they have together, and their ids; the table starts anew beyond any of these.
REMEMBERED, REMEMBERED_CHARS, REMEMBERED_IDS = 500_000, 1 << 24, 1 << 22
_CUT = "\x00"
_SPACE = r"\s\v\x1c-\x1f\x{85}\p{Z}"
#: With spaces kept, a run of white space belongs together and to what follows: texts that have any are cut before each run only. A text with the cut mark is one piece.
_RUNS, _BEFORE_RUN = rf"[{_SPACE}]{{2}}", rf"([^{_SPACE}])([{_SPACE}])"


#: Between such a letter and such a stop there is always a cut; both are of fixed classes in every version of Unicode.
_STOPS = ",.;:!?"
#: The letters of Latin-1.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_LETTER_STOP = rf"([A-Za-zÀ-ÖØ-öø-ÿ])([{_STOPS}]+)"


def byte_alphabet() -> dict[int, str]:
    """How byte-level tokenizers write Latin-1 characters: printable bytes as themselves, the others as the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    names = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(256)}


def _kind(path: str) -> str:
    """dropped: white space ends words and is dropped; kept: a space opens the next piece; whole: anything else."""
    spec = json.loads(Path(path).read_text())
    pre, normal, added = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]) for t in added):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normal:
        return "kept"
    steps = pre.get("pretokenizers", [])
    plain = {n.get("type") for n in (normal or {}).get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}
    if plain and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex"):
        return "dropped"
    return "whole"


class PieceTable:
    """Distinct pieces with their number of ids and, if ``keep_ids``, the ids."""

    def __init__(self, path: str, keep_ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.keep_ids = Tokenizer.from_file(path), _kind(path), keep_ids
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stops = not any(c in t for t in added for c in _STOPS)
        self.plain = not any(t.isalpha() for t in added)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.size = np.zeros(1 << 12, np.int64)
        self.start = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = self.chars = 0

    def _words(self, pieces: pa.Array) -> tuple[np.ndarray, list[str]]:
        """Which pieces are just letters of Latin-1, and these in the byte alphabet, lower-cased if the tokenizer does so."""
        kept = self.kind == "kept"
        mask = pc.match_substring_regex(pieces, rf"^{' ?' if kept else ''}[{_LETTERS}]+$")
        words = pieces.filter(mask)
        words = pc.replace_substring(words, " ", self.alphabet[32]) if kept else pc.utf8_lower(words)
        out = words.to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(~pc.string_is_ascii(pieces.filter(mask)).to_numpy(zero_copy_only=False)):
            head = len(self.alphabet[32]) if kept and out[k].startswith(self.alphabet[32]) else 0
            out[k] = out[k][:head] + out[k][head:].translate(self.alphabet)
        return mask.to_numpy(zero_copy_only=False), out.tolist()

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids in order)."""
        found: list = [None] * len(pieces)
        rest = np.arange(len(pieces))
        if self.kind != "whole" and self.plain:
            mask, words = self._words(pieces)
            tokenize = self.model.tokenize
            for k, word in zip(np.flatnonzero(mask).tolist(), words, strict=True):
                found[k] = [t.id for t in tokenize(word)]
            rest = np.flatnonzero(~mask)
        others = pieces.take(pa.array(rest)).to_pylist()
        for k, e in zip(rest.tolist(), self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            found[k] = e.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))

    def _learn(self, pieces: pa.Array) -> None:
        for lo in range(0, len(pieces), 20_000):
            some = pieces.slice(lo, 20_000)
            sizes, flat = self._encode(some)
            first, n = len(self.at), len(some)
            while first + n > len(self.size):
                self.size, self.start = (np.concatenate([x, np.zeros_like(x)]) for x in (self.size, self.start))
            self.size[first : first + n] = sizes
            self.chars += pc.sum(pc.binary_length(some)).as_py()
            self.at.update(zip(some.to_numpy(zero_copy_only=False).tolist(), range(first, first + n), strict=True))
            if self.keep_ids:
                while self.used + len(flat) > len(self.ids):
                    self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
                self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
                self.ids[self.used : self.used + len(flat)] = flat
                self.used += len(flat)

    def _cut(self, text: pa.Array) -> pa.ListArray:
        if self.stops:
            text = pc.replace_substring_regex(text, _LETTER_STOP, r"\1 \2" if self.kind == "dropped" else rf"\1{_CUT}\2")
        if self.kind == "dropped":
            return pc.split_pattern(pc.replace_substring(text, "\n", " "), " ")
        return pc.split_pattern(pc.replace_substring(pc.replace_substring(text, " ", _CUT + " "), "\n", f"{_CUT}\n{_CUT}"), _CUT)

    def _cut_runs(self, text: pa.Array) -> pa.Array:
        """The pieces of texts in which white space is kept."""
        text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
        marked, runs = (x.to_numpy(zero_copy_only=False) for x in (pc.match_substring(text, _CUT), pc.match_substring_regex(text, _RUNS)))
        kind = pa.large_list(pa.large_string())
        parts, order = [], []
        for rows, cut in ((~marked & ~runs, self._cut), (~marked & runs, self._cut_before_runs), (marked, lambda t: pa.LargeListArray.from_arrays(pa.array(np.arange(len(t) + 1)), t))):
            if rows.any():
                parts.append(cut(text.filter(pa.array(rows))).cast(kind))
                order.append(np.flatnonzero(rows))
        if not parts:
            return pa.array([], kind)
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order))))

    def _cut_before_runs(self, text: pa.Array) -> pa.Array:
        if self.stops:
            text = pc.replace_substring_regex(text, _LETTER_STOP, rf"\1{_CUT}\2")
        return pc.split_pattern(pc.replace_substring_regex(text, _BEFORE_RUN, rf"\1{_CUT}\2"), _CUT)

    def _pieces(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row offsets into, and places in the table of, all pieces of all rows; empty pieces have no ids."""
        if self.kind == "whole":
            text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
            offsets, flat = np.arange(len(text) + 1), text
        else:
            lists = self._cut(text) if self.kind == "dropped" else self._cut_runs(text)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            offsets, flat = offsets - offsets[0], lists.flatten()
        encoded = flat.dictionary_encode()
        distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not distinct:
            return offsets, np.empty(0, np.int64)
        place = self._places(distinct)
        if (new := np.flatnonzero(place < 0)).size:
            if len(self.at) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS or self.used > REMEMBERED_IDS:
                self._clear()
                new = np.arange(len(distinct))
            place[new] = np.arange(len(self.at), len(self.at) + len(new))
            self._learn(encoded.dictionary.take(pa.array(new)))
        return offsets, place[encoded.indices.to_numpy(zero_copy_only=False)]

    def _places(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.at.get, pieces, repeat(-1)), np.int64, len(pieces))

    def counts(self, text: pa.Array) -> np.ndarray:
        """Number of ids of each row, from the sizes of its pieces; null counts as empty."""
        offsets, place = self._pieces(pc.fill_null(text.cast(pa.large_string()), ""))
        total = np.concatenate([[0], np.cumsum(self.size[place])])
        return total[offsets[1:]] - total[offsets[:-1]]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row offsets, ids) of all rows."""
        offsets, place = self._pieces(pc.fill_null(text.cast(pa.large_string()), ""))
        size = self.size[place]
        ends = np.cumsum(size)
        total = np.concatenate([[0], ends])
        take = np.repeat(self.start[place] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return total[offsets], self.ids[take]


_TABLES: dict[tuple[str, bool], PieceTable] = {}


def piece_table(path: str, keep_ids: bool) -> PieceTable:
    """This worker's table for a tokenizer file; kept between the tasks that the worker runs."""
    if (path, keep_ids) not in _TABLES:
        _TABLES[path, keep_ids] = PieceTable(path, keep_ids)
    return _TABLES[path, keep_ids]
