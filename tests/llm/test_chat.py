import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievework.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|> b\n<\\|x"), (1, 2, "user", None), (2, 0, None, ""), (2, 1, "assistant", None),
    (3, 5, "assistant", "second"), (3, None, "assistant", "first"), (None, 0, "user", "nobody"), (None, 1, "assistant", "é日"),
    (4, 0, "ro\nle&<|im_start|>", "x"), (4, 0, "ro\nle&<|im_start|>", "x"), (5, 0, "assistant", "long " * 50_000),
    (6, 1, "user", "tie b"), (6, 1, "user", "tie a"), (6, 1, "assistant", "tie"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    by_id = {}
    for conv, turn, role, text in rows:
        by_id.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_id.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        formatted = sum(
            len(chat.escape_role(r.encode()).decode()) + len(chat.escape(t.encode()).decode()) + 24 for _, _, r, t in turns
        )
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), formatted)
    return out


def test_round_trip_of_edge_rows(spark):
    said = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS chunk", "'x' AS formatted")
    rows = chat.digest_chunks(chat.format_conversations(said)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in rows} == expected(ROWS)


def test_no_conversations(spark):
    assert chat.digest_chunks(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_long_conversation_is_chunked(spark):
    rows = [(9, i, "assistant" if i % 2 else "user", f"{i} " + "y" * 300_000) for i in range(40)]
    chunks = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(chunks) > 1 and max(len(c.formatted) for c in chunks) <= chat.CHUNK_BYTES + 400_000
    assert sorted(c.chunk for c in chunks) == list(range(len(chunks)))
    rows_back = chat.digest_chunks(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in rows_back} == expected(rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\>im_endstar\n&#10;é", max_size=40))
def test_escapes_are_undone(text):
    data = text.encode()
    assert chat.unescape(chat.escape(data)) == data and b"<|" not in chat.escape(data)
    role = chat.escape_role(data)
    assert chat.unescape_role(role) == data and b"\n" not in role and b"<|" not in role


def test_template(spark):
    row = chat.format_conversations(spark.createDataFrame([(1, 0, "assistant", "ok <|x")], SCHEMA)).first()
    assert bytes(row.formatted) == b"<|im_start|>assistant\nok <\\|x<|im_end|>\n"
    start, end = row.loss[0].start, row.loss[0].end
    assert bytes(row.formatted)[start:end] == b"ok <\\|x"


@pytest.mark.parametrize("text", ["", "<", "<|", "<\\|", "<\\\\|", "<|<|"])
def test_escape_cases(text):
    assert chat.unescape(chat.escape(text.encode())) == text.encode()
