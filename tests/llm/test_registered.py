"""The queries as they are registered, and the pipeline with each of its stages, by other ways."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import AWKWARD, SF, documents, frame, near_texts
from tests.llm.test_reading_texts import brute_grams, edit_distance_within
from tests.llm.test_repeats import all_sentence_spans, components, cut, windows
from tidemark.llm import decontaminate, language, pieces, queries
from tidemark.llm.registry import ORACLES, QUERIES
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(k for k, v in ORACLES.items() if v))
def test_query_matches_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(ORACLES[name])
    assert digest(df.columns, rows)[0] == digest([x[0] for x in r.description], r.fetchall())[0]


def digests(kept):
    return sorted((i, n, gone, runs, sha256(text).hexdigest()) for i, n, gone, runs, text in kept)


@pytest.mark.parametrize(("query", "spans"), [
    ("op2_sentence_dedup", lambda rows: all_sentence_spans(rows, 2, 10)),
    ("op3_suffix_dedup", lambda rows: windows(rows, 100))])
def test_removals_by_brute_force(spark, query, spans):
    rows = documents()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES[query](spark, SF).collect())
    assert got == digests(cut(rows, spans(rows)))


def plain_profiles(rows):
    """``language -> n-grams by rank`` of labelled texts outside the held-out quarter."""
    counts = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and (i is None or zlib.crc32(str(i).encode()) % 4 != 2):
            counts.setdefault(lang, Counter()).update(brute_grams(text))
    return {x: [g for g, _ in sorted(c.items(), key=lambda v: (-v[1], v[0]))[:language.TOP]] for x, c in counts.items()}


def plain_language(text, model):
    own = [g for g, _ in sorted(brute_grams(text or "").items(), key=lambda v: (-v[1], v[0]))[:language.TOP]]
    if not own or not model:
        return "und", 0.0
    ranks = {x: {g: i for i, g in enumerate(p)} for x, p in model.items()}
    apart = {x: sum(min(abs(r[g] - i), language.TOP) if g in r else language.TOP for i, g in enumerate(own)) for x, r in ranks.items()}
    best = min(sorted(apart), key=apart.get)
    return best, 1 - apart[best] / (len(own) * language.TOP)


def labelled(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def test_op6_by_brute_force(spark):
    rows = labelled()
    model = plain_profiles(rows)
    got = {r["doc_id"]: r for r in queries.op6_language(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        lang, score = plain_language(text, model)
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score)


def test_op7_decodes_to_the_texts(spark):
    machine = pieces.Transducer(queries.PIECE_MODEL)
    texts = dict(documents())
    got = queries.op7_pieces(spark, SF).collect()
    assert len(got) == len(texts) and machine.root
    for r in got:
        assert r["decoded_sha256"] == sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
        assert r["n_pieces"] == len(r["ids"])


def plain_words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks(rows, items):
    """``{row number: {item: distance}}`` by the edit distance of every item to every text."""
    out = {}
    for n, (_, text) in enumerate(rows):
        w = plain_words(text)
        bag, out[n] = set(w), {}
        for item, own in items:
            # words that aren't there at all are edits each
            if len(own) >= decontaminate.MIN_WORDS and 100 * sum(x not in bag for x in own) <= 20 * len(own):
                d = edit_distance_within(own, w)
                if 100 * d <= 20 * len(own):
                    out[n][item] = d
    return out


def benchmark():
    return [(i, plain_words(t)) for i, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()]


def test_op8_by_brute_force(spark):
    rows = documents()
    want = leaks(rows, benchmark())
    got = {r["doc_id"]: dict(zip(r["item_ids"], r["distances"], strict=True)) for r in queries.op8_decontaminate(spark, SF).collect()}
    assert got == {i: want[n] for n, (i, _) in enumerate(rows)} and any(want.values())


def test_op9_by_the_library(spark):
    from tokenizers import Tokenizer
    direct, start = Tokenizer.from_file(queries.WORD_TOKENIZER), 0
    got = {r["doc_id"]: r for r in queries.op9_token_blocks(spark, SF).collect()}
    for i, t in documents():
        ids = [*direct.encode(t or "", add_special_tokens=False).ids, 2]
        r = got.pop(i)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert not got


# ---- pipeline ----

def plain_stages(rows):
    """What each stage but the last keeps of ``(doc_id, text, lang)``, by brute force."""
    model = plain_profiles(rows)
    rows = [r for r in rows if (x := plain_language(r[1], model))[0] != "und" and x[1] >= corpus_pipeline.LEAST_SCORE]
    yield rows
    first = {}
    for i, t, _ in rows:
        key = re.sub(r"[ \t-\r]+", " ", t or "")
        if i is not None:
            first[key] = min(first.get(key, i), i)
    dropped = {i for i, t, _ in rows if i is not None and i != first[re.sub(r"[ \t-\r]+", " ", t or "")]}
    rows = [r for r in rows if r[0] not in dropped]
    yield rows
    dropped = {i for i, _, _, kept in components([r[:2] for r in rows], 5) if not kept}
    rows = [r for r in rows if r[0] not in dropped]
    yield rows
    found = leaks([r[:2] for r in rows], benchmark())
    yield [r for n, r in enumerate(rows) if not found[n]]


def fixture():
    """Documents in three languages, with nulls, ties, repeated ids, copies, near copies and leaks."""
    rows = [(i, t, x) for i, t, x in labelled()[:90]]
    some = [t for _, t, _ in rows if t and 40 < len(t.split()) < 400][:6]
    item = duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet' LIMIT 1").fetchall()[0][0]
    rows += [(1000 + i, t, None) for i, t in enumerate(some)] + [(2000 + i, "  " + t.replace(" ", " \t", 3), "en") for i, t in enumerate(some)]
    rows += [(3000, item, "en"), (3001, "Before it. " + item + " After it.", None), (None, some[0], None)]
    rows += [(4000 + i, t, "en") for i, t in enumerate(near_texts(some[0], 12))]
    return rows + [(i, t, None) for i, t in AWKWARD if i is None or i not in {r[0] for r in rows}]


def as_frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in ("h", "kept", "keep_id", "component_id", "score", "__text"):
        df = df.withColumn(c, F.lit("x"))
    return df.withColumn("n_chars", F.length("text").cast("long")).repartition(3)


def kept(df):
    return sorted(((r["doc_id"], r["text"], r["lang"]) for r in df.collect()), key=str)


def test_stages_by_brute_force(spark):
    rows = fixture()
    docs = as_frame(spark, rows)
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], plain_stages(rows), strict=True):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert kept(out) == sorted(want, key=str), name
        docs = as_frame(spark, want)  # each stage is judged on its own input
    last = {(r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert last == {(i, sha256((t or "").encode()).hexdigest()) for i, t, _ in want}


def test_stages_of_empty_tables(spark):
    docs = as_frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
    assert frame(spark, []).count() == 0


def test_pipeline_as_registered(spark):
    got = {r["doc_id"]: r["decoded_sha256"] for r in QUERIES["pipeline"](spark, SF).collect()}
    *_, want = plain_stages(labelled())
    assert got == {i: sha256(t.encode()).hexdigest() for i, t, _ in want} and 100 < len(got) < 200
