"""Chat formatting: conversations to training text with a loss mask, assembled byte by byte in numpy.

Turns are ordered by (turn, role, text) within their conversation. In a slice of turns the
lengths of all segments are known, their running sum says where each goes, and headers, texts and
footers are copied into one preallocated buffer that becomes an Arrow binary column.

Template: ``<|im_start|>`` role, newline, text, ``<|im_end|>``, newline. Inside roles and texts a
backslash is put into every ``<|`` (and one more into ``<\\|``, and so on), so that a control string
never stands in a text; roles have their newlines escaped too. Both are undone when read.

A conversation is sorted and written by one task, as one or more numbered chunks of at most ``CHUNK_BYTES`` (or one turn),
so that memory holds a chunk, not a conversation. The loss mask is a list of byte ranges per chunk: the
escaped text of each assistant turn.

Null texts and roles count as empty, null turns come first, and the turns with a null
conversation id form one conversation. Repeated rows are repeated turns. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import columns as C

HEAD, END = b"<|im_start|>", b"<|im_end|>"
CHUNK_BYTES = 4 << 20
_ESCAPE, _UNESCAPE = re.compile(rb"<(\\*)\|"), re.compile(rb"<\\(\\*)\|")
CHUNKS = "conv_id bigint, chunk bigint, formatted binary, n_turns bigint, loss array<struct<start:bigint,end:bigint>>"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def escape(text: bytes) -> bytes:
    return _ESCAPE.sub(rb"<\\\1|", text) if b"<" in text else text


def unescape(text: bytes) -> bytes:
    return _UNESCAPE.sub(rb"<\1|", text) if b"<\\" in text else text


def escape_role(role: bytes) -> bytes:
    return escape(role).replace(b"&", b"&amp;").replace(b"\n", b"&#10;")


def unescape_role(role: bytes) -> bytes:
    return unescape(role.replace(b"&#10;", b"\n").replace(b"&amp;", b"&"))


def _escaped(column: pa.Array, one) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column after ``one``; most columns hold nothing to escape and stay as they are."""
    data, offsets = C.text_bytes(column)
    if one is escape and not (data == ord("<")).any():
        return data, offsets
    values = [one(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer(b"".join(values), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, the offsets of the turns, and where each turn's text begins and ends (2 x n)."""
    role_bytes, role_offsets = _escaped(roles, escape_role)
    body, body_offsets = _escaped(texts, escape)
    role_sizes, body_sizes = np.diff(role_offsets), np.diff(body_offsets)
    turns = np.concatenate([[0], np.cumsum(role_sizes + body_sizes + len(HEAD) + len(END) + 2)])
    starts = turns[:-1]
    text_at = starts + len(HEAD) + role_sizes + 1
    out = np.empty(int(turns[-1]), np.uint8)
    for k, byte in enumerate(HEAD):
        out[starts + k] = byte
    out[C.ragged(starts + len(HEAD), role_sizes)] = role_bytes
    out[text_at - 1] = 10
    out[C.ragged(text_at, body_sizes)] = body
    for k, byte in enumerate(END + b"\n"):
        out[text_at + body_sizes + k] = byte
    return out, turns, np.stack([text_at, text_at + body_sizes])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, number = object(), 0
    for part in C.slices(batches, "text", CHUNK_BYTES):
        out, turns, text = assemble(part.column("role"), part.column("text"))
        ids = part.column("conv_id").to_pylist()
        assistant = np.array([role == "assistant" for role in part.column("role").to_pylist()], bool)
        change = np.flatnonzero([a != b for a, b in zip(ids[1:], ids[:-1])]) + 1
        firsts = np.concatenate([[0], change])
        lasts = np.append(change, len(ids))
        numbers = np.zeros(len(firsts), np.int64)
        if ids[0] == conversation:
            numbers[0] = number + 1
        conversation, number = ids[-1], int(numbers[-1])
        # Chunks tile the buffer, so the binary column is the buffer and the offsets of the chunks.
        formatted = pa.BinaryArray.from_buffers(
            pa.binary(), len(firsts), [None, pa.py_buffer(np.append(turns[firsts], turns[-1]).astype(np.int32)), pa.py_buffer(out)]
        )
        base = np.repeat(turns[firsts], lasts - firsts)
        spans = (text - base)[:, assistant]
        before = np.concatenate([[0], np.cumsum(assistant)])[np.append(firsts, len(ids))]
        loss = pa.ListArray.from_arrays(
            pa.array(before.astype(np.int32)), pa.StructArray.from_arrays([pa.array(spans[0]), pa.array(spans[1])], ["start", "end"])
        )
        picked = pa.array([ids[i] for i in firsts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [picked, pa.array(numbers), formatted, pa.array(lasts - firsts), loss],
            ["conv_id", "chunk", "formatted", "n_turns", "loss"],
        )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Chunks of formatted conversations: conv_id, chunk, formatted, n_turns, loss (byte ranges in the chunk).

    One shuffle by conversation; a partition's turns are sorted on disk and streamed.
    """
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        "turn",
    )
    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return C.map_batches(placed.select("conv_id", "role", "text"), _chunks, CHUNKS)


def _code_points(data: bytes) -> int:
    return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())


def read_turns(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Roles and texts of a chunk, unescaped."""
    for turn in formatted.split(HEAD)[1:]:
        role, _, text = turn.partition(b"\n")
        yield unescape_role(role), unescape(text[: -len(END) - 1])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: list = []

    def close() -> list:
        turns, n_turns, loss, loss_chars, chars = state[1:]
        return [state[0], n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if not state or state[0] != row["conv_id"] or row["chunk"] == 0:
                if state:
                    done.append(close())
                state[:] = [row["conv_id"], hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in read_turns(row["formatted"]):
                state[1].update(role + b"\n" + text + b"\n")
                state[2] += 1
            for span in row["loss"]:
                text = unescape(row["formatted"][span["start"] : span["end"]])
                state[3].update(text)
                state[4] += _code_points(text)
            state[5] += _code_points(row["formatted"])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), types)], names)


def digest_chunks(chunks: DataFrame) -> DataFrame:
    """Read formatted chunks back: one row of counts and digests per conversation.

    A SHA-256 is a chain, so a conversation's chunks pass one task, one after the other; it
    holds one chunk at a time. Chunks that come straight from :func:`format_conversations`
    are in order already.
    """
    return C.map_batches(chunks, _digests, DIGESTS)
