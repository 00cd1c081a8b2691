r"""Chat formatting by columnar byte assembly, with a reversible template.

A turn is ``### Role: text</turn>`` and a newline. Inside texts and roles backslash, ``#`` and ``<`` become ``\\``, ``\h`` and ``\l`` (in roles also ``:``,
``\c``), so no text can hold a control string and the template can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import tidy

END = "</turn>\n"
NAMED = {"user": "User", "assistant": "Assistant", "system": "System"}
_ROLES = {v: k for k, v in NAMED.items()}
_ESCAPES = (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"))
_BACK = {"\\": "\\", "h": "#", "l": "<", "c": ":"}
#: Rows of one assembly; bounds a buffer whatever the batch size is.
ROWS = 4096


def escape(text: pa.Array) -> pa.Array:
    for raw, safe in _ESCAPES:
        text = pc.replace_substring(text, raw, safe)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def header(role: str) -> str:
    """Named roles are capitalised; any other role stands after ``@``."""
    safe = escape(pa.array([role]))[0].as_py().replace(":", "\\c")
    return f"### {NAMED.get(role, '@' + safe)}: "


def _role_of(name: str) -> str:
    return unescape(name[1:]) if name[0] == "@" else _ROLES[name]


def _scatter(out: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copies ``data``, which holds segments of ``sizes`` back to back, to ``starts`` in ``out``, by one index."""
    ends = np.cumsum(sizes)
    out[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(data))] = data


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array, back to back, and each string's size."""
    text = text.cast(pa.large_string())
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.empty(0, np.uint8), np.diff(at)


def assemble(conv: np.ndarray, role: pa.Array, text: pa.Array, trained: str = "assistant") -> tuple[np.ndarray, pa.Array, pa.ListArray]:
    """Sorted turns -> where each conversation's run starts, its formatted text, and its loss spans as byte positions (start, end, ...)."""
    n = len(text)
    roles = role.dictionary_encode()
    heads = pa.array([header(r) for r in roles.dictionary.to_pylist()], pa.string()).take(roles.indices)
    (head, head_n), (body, body_n) = _bytes(heads), _bytes(escape(text))
    tail = np.frombuffer(END.encode(), np.uint8)
    sizes = head_n + body_n + len(tail)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    _scatter(out, head, starts, head_n)
    _scatter(out, body, starts + head_n, body_n)
    _scatter(out, np.tile(tail, n), ends - len(tail), np.full(n, len(tail)))
    first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]])) if n else np.empty(0, int)
    cuts = np.append(starts[first], ends[-1] if n else 0).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(out)])
    masked = pc.equal(role, trained).to_numpy(zero_copy_only=False).astype(bool)
    run = np.searchsorted(first, np.arange(n), side="right") - 1
    spans = np.stack([starts + head_n, ends - len(tail)], 1)[masked] - cuts[run[masked]][:, None]
    counts = np.concatenate([[0], np.cumsum(np.bincount(run[masked], minlength=len(first)) * 2)])
    return first, texts, pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), pa.array(spans.ravel().astype(np.int64)))


def _runs(ids: pa.Array) -> np.ndarray:
    """Numbers of the runs of equal ids, compared as 64-bit integers; null is an id of its own."""
    value, null = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), pc.is_null(ids).to_numpy(zero_copy_only=False)
    return np.cumsum(np.concatenate([[False], (value[1:] != value[:-1]) | (null[1:] != null[:-1])])) if len(ids) else np.empty(0, np.int64)


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, previous = 0, None
    for whole in batches:
        for lo in range(0, whole.num_rows, ROWS):
            batch = whole.slice(lo, ROWS)
            ids = batch.column("id")
            conv = _runs(ids)
            first, texts, spans = assemble(conv, batch.column("role"), batch.column("text"))
            keys = ids.take(pa.array(first))
            part = part + 1 if previous is not None and keys[0] == previous[0] else 0
            counts = np.diff(np.append(first, batch.num_rows))
            yield pa.RecordBatch.from_arrays([keys, pa.array([part] + [0] * (len(first) - 1), pa.int64()), pa.array(counts, pa.int64()), texts.cast(pa.string()), spans], names=["id", "part", "n_turns", "formatted", "loss_spans"])
            part, previous = (part if len(first) == 1 else 0), (keys[-1],)


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, part, n_turns, formatted, loss_spans): each conversation's turns in order, as one text.

    ``loss_spans`` are byte positions (start, end, start, end, ...) of the escaped assistant texts. A conversation that reaches over a batch
    is continued in further parts, next to each other in the same partition, so a conversation of any length needs bounded memory. Null texts
    and roles count as empty; a null conversation id is a conversation of its own; turns with the same number go by role, then text, and
    repeated rows are repeated turns. Other columns are not read. An empty table gives no rows.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    ordered = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    return ordered.mapInArrow(tidy(_format_batches), "id long, part long, n_turns long, formatted string, loss_spans array<long>")


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted text; start and end are the byte range of the escaped text."""
    raw = formatted.encode()
    data = np.frombuffer(raw, np.uint8)
    stops = np.flatnonzero(data == ord("<"))  # only the template has this byte
    colons = np.flatnonzero(data == ord(":"))
    starts = np.concatenate([[0], stops + len(END)])[:-1] if len(stops) else np.empty(0, np.int64)
    marks = colons[np.searchsorted(colons, starts)] if len(starts) else starts
    return [(_role_of(raw[a + 4 : m].decode()), unescape(raw[m + 2 : b].decode()), int(m + 2), int(b)) for a, m, b in zip(starts, marks, stops, strict=True)]


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    done: list[tuple] = []
    state = None

    def close() -> None:
        if state:
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

    for batch in batches:
        for conv, part, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "formatted", "loss_spans")), strict=True):
            if part == 0:
                close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            elif state is None or conv != state[0] or part != follows:
                raise ValueError(f"part {part} of conversation {conv} doesn't follow the part before it")
            follows = part + 1
            masked = set(zip(spans[::2], spans[1::2], strict=True))
            for role, text, a, b in read_back(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if (a, b) in masked:
                    state[3] += len(text)
                    state[4].update(text.encode())
            state[5] += len(formatted)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], kind) for k, kind in enumerate(types)], names=names)
        done.clear()
    close()
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], kind) for k, kind in enumerate(types)], names=names)


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Reads ``format_chats`` output back: turns, text under the loss mask and sizes of each conversation, part after part; fails on parts that aren't next to each other in order."""
    return formatted.mapInArrow(tidy(_digest_batches), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PLANTED = r"\### Assistant: </turn> ok"

#: The digests in DuckDB's SQL, with the template's lengths.
ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) AS escaped,
             CASE role WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'system' THEN 12 ELSE 7 + length(role) END + 8 AS frame FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(escaped + frame)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
