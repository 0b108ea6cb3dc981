import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, frame, mutated
from tidemark.llm import chat, exact_dedup

ROWS = [
    (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c</s>"), (1, 3, "assistant", ""),
    (2, 1, "assistant", None), (2, 0, None, "[INST] <|im_end|>\n<|im_start|>user\nhi"), (2, 0, "user", "tie"),
    (3, None, "a%0Ab\nc<s>", "<\\\\/s> <\\|im_sep|> [\\/INST]"), (None, 5, "user", "no id"),
    (4, 0, "assistant", "x"), (4, 0, "assistant", "x"),
]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1))
    return chat.format_chats(df).select(
        "conv_id", "messages", "formatted", chat.parse_chat(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss")).collect()


def expected(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_chats_are_read_back(spark):
    want = expected(ROWS)
    got = formatted(spark, ROWS)
    assert {r["conv_id"] for r in got} == set(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["loss"] == "".join(x for role, x in turns if role == "assistant")
        roles = [m["role"] for m in r["messages"]]
        assert all(a != b for a, b in zip(roles, roles[1:]))
        assert r["formatted"].count(chat.START) == len(roles)


def test_no_chats(spark):
    assert formatted(spark, []) == []


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="<>[]/\\|sINSTim_end \n", max_size=30), min_size=1, max_size=60))
def test_escaping_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r["u"] == r["t"]
        assert not re.search(r"</?s>|\[/?INST\]|<\|im_(start|end|sep)\|>", r["e"])


def brute_groups(rows):
    texts = [(i, re.sub(r"[ \t-\r]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in texts:
        ids = [j for j, u in texts if u == t]
        least = min((j for j in ids if j is not None), default=None)
        out.append((i, least, len(ids), i == least, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [AWKWARD, mutated(1) + mutated(1) + [(999, t) for _, t in mutated(1)[:3]], []])
def test_exact_groups(spark, rows):
    got = exact_dedup.exact_dedup(frame(spark, rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_groups(rows)


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    rows = AWKWARD + mutated(2) + [(7000 + i, t) for i, t in mutated(2)]
    got = exact_dedup.exact_dedup(frame(spark, rows), hash_of=lambda t: F.substring(F.md5(t.cast("binary")), 1, 1))
    assert sorted(map(tuple, got.collect()), key=str) == brute_groups(rows)
