import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, SF, documents, frame, mutated
from tidemark.llm import decontaminate, language, packing, pieces, pii, queries, rangecoder

LONG = [(50, "One word. " * 40_000)]


# ---- language ----

def test_language_is_right_on_held_out_documents(spark):
    out = queries.op6_language(spark, "/root/testdata/sf0.01").alias("o").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.99 * len(out)
    assert all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2


def brute_grams(text):
    words = ["".join(c.lower()[0] if c.isalpha() else " " for c in text).split()][0]
    out = {}
    for w in words:
        p = f" {w} "
        for n in (1, 2, 3):
            for i in range(len(p) - n + 1):
                g = p[i:i + n]
                if g != " " and not (n == 3 and g[1] == " "):
                    key = 0
                    for c in g:
                        key = key << 21 | ord(c)
                    out[key] = out.get(key, 0) + 1
    return out


def test_grams_by_brute_force():
    texts = ["", "Ab ab", "...", "é日本 x1y", "a\u0000b", "Hello, hello world"]
    t, g, n = language.grams(texts)
    for i, text in enumerate(texts):
        assert dict(zip(g[t == i].tolist(), n[t == i].tolist())) == brute_grams(text)
        order = list(zip((-n[t == i]).tolist(), g[t == i].tolist()))
        assert order == sorted(order)


def test_language_of_awkward_texts(spark):
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in
           language.identify(frame(spark, AWKWARD), {"xx": [ord("a")], "yy": [ord("b")]}).collect()}
    assert got[1, "und"] == got[2, "und"] == got[3, "und"] == 0
    assert (9, "xx") in got
    assert language.identify(frame(spark, AWKWARD), {}).where("lang_pred <> 'und'").isEmpty()
    assert language.identify(frame(spark, []), {}).count() == 0
    docs = frame(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string"))
    assert language.profiles(docs) == {}
    kept = language.keep_identified(frame(spark, AWKWARD), {"xx": [ord("a")]}, 0.0)
    assert kept.columns == frame(spark, AWKWARD).columns
    assert kept.where("doc_id IN (1, 2, 3)").count() == 0 and kept.where("doc_id = 5").count() == 2


# ---- personal data ----

def brute_pii(t):
    def luhn(d):
        s = [int(c) for c in d][::-1]
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(s)) % 10 == 0

    def digits(x):
        return re.sub("[^0-9]", "", x)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_by_brute_force():
    rng = random.Random(1)
    alphabet = "aZ9015.@-+ ()%_\n,é"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(20_000)]
    texts += [t for _, t in documents()] + ["4111 1111 1111 1111 4111-1111-1111-1111", "a@b@c.de a@b.c.d@e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0001.0.0.0"]
    for t in texts:
        assert pii.base_spans(t) == brute_pii(t), t


def test_distant_partners_get_the_label(spark):
    weights = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    t = ("Card 4111 1111 1111 1111 was used by jane.doe@mail.example.com today.\n" + "Some words here. " * 50
         + "Again 4111.1111.1111.1111 and jane.doe wrote back.")
    base, added = pii.find(t, weights)
    assert [k for k, _, _ in base] == ["email", "card"]
    assert ("email", t.rindex("jane.doe"), t.rindex("jane.doe") + 8) in added
    assert ("card", t.rindex("4111."), t.rindex("4111.") + 19) in added
    assert all((k, s, e) not in base for k, s, e in added)
    # nothing is added to a text without data, or far from it in kind
    assert pii.find("In 1999 there were 25 people @home, about +3 degrees.", weights) == ([], [])
    assert pii.find("Write to bob12@mail.example.com in 1999, room 25.", weights)[1] == []


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_the_field_decides_in_texts_without_a_hit(spark, sf):
    weights = pii.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    assert pii.MOST_BOND >= weights.skip > weights.chain >= pii.LEAST_BOND
    t = ("Card 4111 1111 1111 1111 was used by jane.doe@mail.example.com today.\n" + "Some words here. " * 50
         + "Again 4111.1111.1111.1111 and jane.doe wrote back.")
    assert {(k, t[s:e]) for k, s, e in pii.find(t, weights)[1]} == {("card", "4111.1111.1111.1111"), ("email", "jane.doe")}
    # a key of letters and digits is none of the kinds, where the sample has any
    assert sf == SF or pii.find("Key 24be64439e3e49cf46b2d7c90f3602a3d0b907ff here.", weights) == ([], [])
    for t, kind, token in (("Mail admin@localhost for it.", "email", "admin@localhost"),
                           ("Paid by 4111111111111112, again 4111111111111112.", "card", "4111111111111112")):
        assert pii.base_spans(t) == []
        assert pii.find(t, weights) == ([], [(kind, m.start(), m.end()) for m in re.finditer(token, t)])
    # what the field is asked is the same with and without data tokens to look at
    for t in ["", "No data here.", "Only 3 of them.", *(t for _, t in documents())]:
        base = pii.base_spans(t)
        tokens = pii.tokens_of(t, base)
        p = pii.field_labels(t, tokens, weights) if tokens else []
        assert pii.find(t, weights)[1] == [
            (pii.LABELS[r.argmax()], s, e) for (s, e, k), r in zip(tokens, p, strict=True)
            if not k and r.argmax() and r.max() >= pii.LEAST]


def test_messages_agree_with_exact_marginals():
    """On a chain of three tokens, where message passing is exact."""
    weights = pii.Field(np.random.default_rng(0).normal(size=(5, pii._FEATURES)), 0.7, 3.0)
    t = "12 x@y 34"
    tokens = [(0, 2, 0), (3, 6, 0), (7, 9, 0)]
    u = np.array([pii._shape(t[s:e]) for s, e, _ in tokens]) @ weights.weights.T
    joint = np.zeros((5, 5, 5))
    for a in range(5):
        for b in range(5):
            for c in range(5):
                joint[a, b, c] = np.exp(u[0, a] + u[1, b] + u[2, c] + weights.chain * ((a == b) + (b == c)))
    joint /= joint.sum()
    got = pii.field_labels(t, tokens, weights)
    for i, axes in enumerate(((1, 2), (0, 2), (0, 1))):
        assert np.allclose(got[i], joint.sum(axis=axes), atol=0.01)


def test_messages_over_skip_edges_agree_with_exact_marginals():
    """A tree: two distant pairs of equal tokens, one pair joined by a chain edge."""
    field = pii.Field(np.random.default_rng(3).normal(size=(5, pii._FEATURES)) / 2, 0.6, 1.5)
    t = "12345 678" + " far" * 20 + "\n12345" + " away" * 20 + "\n678"
    tokens = [(m.start(), m.end(), 0) for m in re.finditer("[0-9]+", t)]
    assert pii._neighbours(t, tokens) == [(0, 1)] and pii._partners(t, tokens) == [(0, 2), (1, 3)]
    u = np.array([pii._shape(t[s:e]) for s, e, _ in tokens]) @ field.weights.T
    joint = np.zeros((5,) * 4)
    for a, b, c, d in np.ndindex(joint.shape):
        joint[a, b, c, d] = np.exp(u[0, a] + u[1, b] + u[2, c] + u[3, d] + field.chain * (a == b)
                                   + field.skip * ((a == c) + (b == d)))
    joint /= joint.sum()
    got = pii.field_labels(t, tokens, field)
    for i in range(4):
        assert np.allclose(got[i], joint.sum(axis=tuple(k for k in range(4) if k != i)), atol=0.02)


def test_op4_by_its_own_parts(spark):
    """The registered query against texts taken one by one, and spans that only the field finds."""
    sf = "/root/testdata/sf0.01"
    field = pii.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op4_pii(spark, sf).collect()}
    added = 0
    for i, t in documents(sf):
        base, more = pii.find(t or "", field)
        assert sorted(base) == sorted(brute_pii(t or ""))
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert r["spans"] == pii.joined([*base, *more]) and r["n_added"] == len(more)
        added += len(more)
    assert 5 <= added <= 100


def test_pii_of_awkward_texts(spark):
    weights = pii.fit(frame(spark, []))
    rows = AWKWARD + LONG + [(60, "a" * 50_000 + "@"), (61, "1" * 5_000 + ".1.1.1"), (62, "9" * 20_000)]
    got = pii.find_pii(frame(spark, rows), weights).collect()
    assert len(got) == len(rows) and all(r["added"] == [] for r in got)
    assert pii.find_pii(frame(spark, []), weights).count() == 0


# ---- pieces ----

def brute_path(machine, text):
    """Least weight over all segmentations of the whole normalised text."""
    weight = {}

    def walk(state, piece):
        if state[1] >= 0:
            weight[piece] = state[2]
        for c, s in state[0].items():
            walk(s, piece + c)
    walk(machine.root, "")
    marked = [("▁", True)] + [("▁", True) if c == " " else (c, c == "▁" and None) for c in text]
    n = len(marked)
    best = [0.0] + [float("inf")] * n
    for i in range(n):
        c, own = marked[i]
        if own is not True:
            best[i + 1] = min(best[i + 1], best[i] + machine.byte_weight * len(c.encode()))
        for j in range(i + 1, min(n, i + 40) + 1):
            if any(o is None for _, o in marked[i:j]):
                break
            w = weight.get("".join(c for c, _ in marked[i:j]))
            if w is not None:
                best[j] = min(best[j], best[i] + w)
    return best[n]


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(queries.PIECE_MODEL)


def test_paths_are_the_shortest(machine):
    known = pieces.Words(machine.words)
    cost = {}

    def walk(state):
        if state[1] >= 0:
            cost[state[1]] = state[2]
        for s in state[0].values():
            walk(s)
    walk(machine.root)
    texts = [t[:300] for _, t in documents()[:40]] + ["a  b", " a", "a ", "\n x", "x\n\ny", "▁a", "a▁ b\tc\r\n", "日本😀"]
    ids, n = known.texts([t.encode().replace(b"\n", b" \n") for t in texts])
    at = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        own = ids[at[i]:at[i + 1]].tolist()
        assert sum(cost.get(x, machine.byte_weight) for x in own) == pytest.approx(brute_path(machine, t))
        assert machine.decode(np.array(own), np.array([len(own)])) == [t.encode()]


def test_runs_of_spaces_take_their_own_pieces(machine):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    cost = {}

    def walk(state):
        if state[1] >= 0:
            cost[state[1]] = state[2]
        for s in state[0].values():
            walk(s)
    walk(machine.root)
    assert {i for i in range(sp.vocab_size()) if sp.id_to_piece(i).strip("▁") == ""} <= set(cost)
    rng = random.Random(2)
    texts = ["a   b", " " * 8 + "x = 1", "  ", "a  \n    b  ", "\n  \n a", "▁  ▁", " " * 40] + [
        "".join(rng.choices(["a", "the", " ", "  ", "     ", "\n", "▁", "é"], k=14)) for _ in range(200)]
    ids, n = pieces.Words(machine.words).texts([t.encode().replace(b"\n", b" \n") for t in texts if t])
    at = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        own = ids[at[i]:at[i + 1]].tolist()
        assert sum(cost.get(x, machine.byte_weight) for x in own) == pytest.approx(brute_path(machine, t)), t
        assert machine.decode(np.array(own), np.array([len(own)])) == [t.encode()]
    assert n[0] == 3


def test_pieces_of_awkward_texts(spark):
    rows = AWKWARD + mutated(6, 10) + LONG + [(70, " \n \n  a▁b "), (71, "\n"), (72, "x" * 20_000)]
    got = pieces.encode_pieces(frame(spark, rows), queries.PIECE_MODEL).collect()
    want = sorted(((i, (t or "").encode()) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], bytes(r["decoded"])) for r in got), key=str) == want
    assert all((len(r["ids"]) == 0) == (not r["decoded"]) for r in got)
    assert pieces.encode_pieces(frame(spark, []), queries.PIECE_MODEL).count() == 0


def test_words_are_forgotten_beyond_the_limit(machine):
    few = pieces.Words(machine.words, limit=5)
    a = few.texts([b"a b c", b"d e f"])
    b = pieces.Words(machine.words).texts([b"a b c", b"d e f"])
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


# ---- leaks ----

def edit_distance_within(item, text):
    last = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        now = [i]
        for j, y in enumerate(text, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return min(last)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_best_match_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = rng.integers(0, 4, rng.integers(1, 70)), rng.integers(0, 4, rng.integers(0, 90))
        assert decontaminate.best_match(a.astype(np.uint64), b.astype(np.uint64)) == edit_distance_within(a.tolist(), b.tolist())


def test_leaks_by_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 60)))) for i in range(25)] + [(90, None), (None, "a " * 20), (91, "")]
    docs = []
    for i in range(300):
        w = rng.choices(words, k=rng.randint(0, 80))
        if i % 3:
            own = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, len(own) // 4)):
                p = rng.randrange(len(own))
                own[p:p + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 1))
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((i, ", ".join(w).upper()))
    docs += AWKWARD
    got = {(r["doc_id"], r["n_words"]): dict(zip(r["item_ids"], r["distances"])) for r in
           decontaminate.find_leaks(frame(spark, docs), items_of(spark, items)).collect()}
    hits = found = 0
    for i, t in docs:
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
        have = got[i, len(w)] if (i, len(w)) in got else got[i, next(n for d, n in got if d == i)]
        for item, text in items[:25]:
            own = text.split()
            if len(own) >= decontaminate.MIN_WORDS and w:
                d = edit_distance_within(own, w)
                if d * 100 <= 20 * len(own):
                    hits += 1
                    found += item in have
                    assert have.get(item, d) >= d
                else:
                    assert item not in have
    assert hits > 100 and found >= 0.97 * hits


@pytest.mark.parametrize("n", [8, 9, 10, 12, 14, 15, 16, 17, 20, 24, 31, 59])
def test_no_length_is_missed_at_the_full_distance(n):
    """Edited copies of items of one length, with the least distances, and verbatim ones at every place."""
    rng = random.Random(n)
    words = [f"w{i}" for i in range(2_000)]
    items, texts = [], []
    for i in range(80):
        own = rng.choices(words, k=n)
        items.append((i, " ".join(own)))
        for _ in range(n * 20 // 100 if i % 4 else 0):
            p = rng.randrange(len(own))
            own[p:p + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 1))
        texts.append(rng.choices(words, k=i % 7) + own + rng.choices(words, k=i % 3))
    found = list(decontaminate._search(decontaminate.build_index(items), 20)([" ".join(t).encode() for t in texts]))
    assert sorted((t, d) for t, i, d in found if t == i) == [
        (i, edit_distance_within(items[i][1].split(), t)) for i, t in enumerate(texts)]


def test_no_items_no_leaks(spark):
    assert decontaminate.find_leaks(frame(spark, AWKWARD), items_of(spark, [])).where("size(item_ids) > 0").isEmpty()
    assert decontaminate.drop_leaks(frame(spark, AWKWARD), items_of(spark, [])).count() == len(AWKWARD)
    assert decontaminate.find_leaks(frame(spark, []), items_of(spark, [(1, "a b " * 10)])).count() == 0


# ---- token blocks ----

@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 5_000, 60_000])
def test_blocks_give_back_their_ids(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 999) if n % 2 else rng.integers(0, 1000, n)
    lengths = np.array([n, 0]) if n < 40 else np.array([n // 3, 0, n - n // 3])
    block = rangecoder.encode_block(np.arange(len(lengths)) - 1, lengths, ids, 1000)
    doc, size, back = rangecoder.decode_block(block)
    assert back.tolist() == ids.tolist() and size.tolist() == lengths.tolist() and doc.tolist() == list(range(-1, len(lengths) - 1))


def test_a_block_is_smaller_than_its_static_entropy():
    coder, texts, size = packing.LowerCaseTokenizer(queries.WORD_TOKENIZER), [t.encode() for _, t in documents("/root/testdata/sf0.1") if t], 0
    parts = []
    while size < packing.BLOCK_IDS:
        ids, _ = coder.encode(texts[:200])
        parts, size, texts = [*parts, ids], size + len(ids), texts[200:]
    ids = np.concatenate(parts)[:packing.BLOCK_IDS].astype(np.int64)
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    block = rangecoder.encode_block(np.array([1]), np.array([len(ids)]), ids, coder.size)
    assert 8 * len(block) < len(ids) * -(p * np.log2(p)).sum()
    assert (rangecoder.decode_block(block)[2] == ids).all()


def test_words_are_found_after_all_were_forgotten():
    texts = [t.encode() for _, t in documents() if t]
    whole, small = packing.LowerCaseTokenizer(queries.WORD_TOKENIZER), packing.LowerCaseTokenizer(queries.WORD_TOKENIZER)
    small.words.limit = 50
    for a in range(0, len(texts), 7):
        (x, n), (y, m) = whole.encode(texts[a:a + 7]), small.encode(texts[a:a + 7])
        assert x.tolist() == y.tolist() and n.tolist() == m.tolist()
    assert whole.encode([b"", b" ", b""])[1].tolist() == [0, 0, 0]


def test_words_are_cut_where_tokens_end():
    direct, rng = packing.LowerCaseTokenizer(queries.WORD_TOKENIZER), np.random.default_rng(5)
    signs = [*"abcdefghijklmnopqrstuvwxyzABCZ  ''..,!?-<|>=0123456789", *"éèßÉÀÿ÷×µªſKİıσΣς", "\u0301", "\u0338", "\u00a0", "\u3000",
             "\x0b", "\x0c", "\x1c", "\x85", "\n", "\t", "'s", "'ve ", "'LL", "½", "٣", "中", "😀", "\u200d", "ﬁ", "\x00", "\x7f"]
    texts = ["".join(signs[k] for k in rng.integers(0, len(signs), rng.integers(0, 60))) for _ in range(3_000)]
    for a in range(0, len(texts), 500):
        ids, n = direct.encode([t.encode() for t in texts[a:a + 500]])
        for got, t in zip(np.split(ids, np.cumsum(n)[:-1]), texts[a:a + 500], strict=True):
            assert got.tolist() == direct.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_a_word_is_encoded_once_whatever_ends_it():
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "aeiou"]
    coder, given = packing.LowerCaseTokenizer(queries.WORD_TOKENIZER), []
    encode = coder.words.encode
    coder.words.encode = lambda *a: given.append(len(a[-1])) or encode(*a)
    ids, _ = coder.encode([" ".join(w + end for end in ("", "!!", "?", ");", ".") for w in words).encode()])
    assert sum(given) == len(words) + 4
    text = " ".join(w + end for end in ("", "!!", "?", ");", ".") for w in words)
    assert ids.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("code", ["encode_block", "decode_block"])
def test_a_block_is_learned_in_few_rounds(code, monkeypatch):
    ids = np.random.default_rng(2).zipf(1.3, packing.BLOCK_IDS) % 49_408
    block = rangecoder.encode_block(np.array([1]), np.array([len(ids)]), ids, 49_408)
    calls, learn = [], rangecoder.Model.learn
    monkeypatch.setattr(rangecoder.Model, "learn", lambda *a: calls.append(1) or learn(*a))
    if code == "encode_block":
        assert rangecoder.encode_block(np.array([1]), np.array([len(ids)]), ids, 49_408) == block
    else:
        assert (rangecoder.decode_block(block)[2] == ids).all()
    # each round costs tables of the size of the vocabulary, whatever it learns
    assert 0 < len(calls) <= 32


@pytest.mark.parametrize(("vocabulary", "n"), [(1, 100), (2, 3_000), (70_000, 90_000), (1 << 20, 40_000)])
def test_vocabularies_of_any_size(vocabulary, n):
    ids = np.random.default_rng(n).integers(0, vocabulary, n)
    block = rangecoder.encode_block(np.array([1]), np.array([n]), ids, vocabulary)
    assert (rangecoder.decode_block(block)[2] == ids).all()


def test_repetition_is_learned():
    ids = np.tile(np.random.default_rng(0).integers(0, 49_000, 500), 200)
    assert len(rangecoder.encode_block(np.array([1]), np.array([len(ids)]), ids, 49_408)) < 0.5 * 2 * len(ids)


@pytest.mark.parametrize("place", [0, 9, 60, -1])
def test_damage_is_noticed(place):
    ids = np.random.default_rng(1).integers(0, 50, 3_000)
    block = bytearray(rangecoder.encode_block(np.array([7]), np.array([3_000]), ids, 50))
    block[place if place >= 0 else len(block) - 400] ^= 0x41
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(block))
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(block[:100]))


def test_token_blocks_hold_what_the_tokenizer_gives(spark):
    from tokenizers import Tokenizer
    direct = Tokenizer.from_file(queries.WORD_TOKENIZER)
    odd = [(200, "It's they'RE a.b c.,d e... f,, É.È,  x y <|endoftext|> <|ENDOFTEXT|> 12.5, don't."),
           (201, "é. ́a .\n,"), (202, "a" * 3_000 + ".")]
    rows = AWKWARD + documents()[:80] + LONG + odd
    blocks = packing.write_blocks(frame(spark, rows), queries.WORD_TOKENIZER, 2, block_ids=5_000)
    assert blocks.count() > 3
    got = packing.read_blocks(blocks).collect()
    start = 0
    want = sorted(((i is not None, i or 0, (t or "").encode()) for i, t in rows))
    assert len(got) == len(want)
    for r, (known, i, raw) in zip(sorted(got, key=lambda r: r["start"]), want, strict=True):
        assert (r["doc_id"], r["start"]) == (i if known else None, start)
        assert r["ids"] == [*direct.encode(raw.decode(), add_special_tokens=False).ids, 2]
        start += len(r["ids"])
    digest = packing.digests(packing.read_blocks(blocks)).collect()
    crc = {r["start"]: zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) for r in got}
    assert {r["start"]: r["ids_crc32"] for r in digest} == crc
    assert packing.write_blocks(frame(spark, []), queries.WORD_TOKENIZER, 2).count() == 0
    assert json.dumps(sorted(crc.values()))
