import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, documents, frame
from tidemark.llm import queries, spelling

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, change=True, least=7):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if change and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 2}


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    """All result columns by comparing all words with all."""
    found = {w: [x for x in n if abs(len(x) - len(w)) <= 1 and near(w, x)] for w in n}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(found[w]), form[w] and n[form[w]])
    return out


def listed(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_op12_by_brute_force(spark):
    got = listed(queries.op12_spelling(spark, "/root/testdata/sf0.001"))
    want = brute(counted(documents()))
    assert got == want
    assert sum(1 for v in got.values() if v[0]) >= 5


def test_chains_of_forms_and_ties(spark):
    docs = [(1, "receivee " * 2 + "Receive " * 300 + "receiver " * 300 + "recieve " * 3),
            (2, "receives " * 30 + "zreceives " * 3 + "xzreceives " * 2),
            (3, "bananas " * 40 + "bananaz " * 400 + "banana " * 9 + "bananasz " * 4),
            (4, "aaaaaaa " * 200 + "aaaaaaaa " * 20 + "aaaaaaaaa " * 2 + "aabaaaaaa " * 2),
            (5, "élèveçàü " * 30 + "élèveçàù " * 3 + "ÉLÈVEÇÀÜ " * 2 + "×÷×÷×÷×÷ " * 5)]
    got = listed(spelling.variants(frame(spark, docs)))
    assert got == brute(counted(docs, change=False))
    assert got["receivee"][0] == "receive"  # as frequent as receiver, and before it
    assert got["xzreceives"][1] in ("receive", "zreceives", "xzreceives")
    assert got["aaaaaaaaa"][1] == "aaaaaaa"


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("ab", min_size=7, max_size=10), min_size=2, max_size=120))
def test_pairs_by_brute_force(spark, found):
    n = Counter(found)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    pairs = [tuple(sorted((r["a"], r["b"]))) for r in spelling.near_pairs(words).collect()]
    assert sorted(pairs) == sorted((a, b) for a in n for b in n if a < b and near(a, b))


def test_longer_words_and_shorter_limits(spark):
    docs = [(1, " ".join(x for w in ("abcdefghijklmnopqrstuvwxyzabcdef" * 3, "wordy", "words", "word")
                         for i in range(len(w)) for x in (w[:i] + w[i + 1:], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1:], w, w)))] * 2
    got = listed(spelling.variants(frame(spark, docs), least_length=4, times=2))
    n = counted(docs, change=False, least=4)
    assert {w: v[2:4] for w, v in got.items()} == {w: v[2:4] for w, v in brute(n).items()}


def test_awkward_texts(spark):
    for change in (None, spelling.damaged):
        got = listed(spelling.variants(frame(spark, AWKWARD), change=change))
        assert got == brute(counted(AWKWARD, change=change is not None))
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "")])).count() == 0
    docs = frame(spark, AWKWARD).withColumn("word", F.lit("clashing")).withColumn("n", F.lit(9))
    assert listed(spelling.variants(docs)) == brute(counted(AWKWARD, change=False))
