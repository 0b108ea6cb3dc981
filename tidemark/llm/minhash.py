"""Near-duplicate detection by MinHash with tensored banding.

Two collections of ``m`` small hashes, each of ``k`` minima, take ``2 m k``
minhashes; a table key combines one hash of either collection, which makes
``m * m`` tables.  A pair of similarity s meets with probability
``(1 - (1 - s**k)**m)**2``: 0.99998 at 0.8 with the defaults, for 96 minhashes
where 256 separate tables of 6 would take 1,536.

Candidates are confirmed on the documents' full shingle sets.  Nothing pairs up
the members of a table slot with each other:

1. Documents with one shingle set are one class from the start.
2. Only small hashes shared by two classes are combined to keys.
3. Each class is compared with one pivot, the smallest class it shares a key
   with, and the confirmed pairs make components.
4. What is left are the pairs of a common key in different components.  Members
   outside a slot's largest component are compared with the others that share a
   small hash, once per pair, if a longer sketch of one-bit minima comes within
   ``SIGMAS`` standard deviations of what the threshold lets expect.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, id_text, slices, stage
from tidemark.llm.components import components
from tidemark.llm.hashing import U, mix, seeds, words

PERCENT = 80
HASHES = 16      # m: small hashes in either collection
MINIMA = 3       # k: minima in each
SKETCH = 32      # numbers of 64 bits in the sketch of step 4
SIGMAS = 4.0     # a pair right at the threshold is farther apart once in 30,000 times


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct runs of ``n`` words, sorted, and where each
    text's set begins.  A text with fewer words has its whole sequence as one."""
    h, first = words(texts)
    count = np.diff(first)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(texts)), made)
    at = np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made) + first[text]
    x = np.zeros(len(at), dtype=U)
    size = np.minimum(count, n)[text]
    for j, a in enumerate(seeds(n)):
        here = j < size
        x[here] += mix(h[at[here] + j] ^ a) * a
    x = mix(x + size.astype(U))
    order = np.lexsort((x, text))
    x, text = x[order], text[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    x, text = x[new], text[new]
    return x, np.searchsorted(text, np.arange(len(texts) + 1))


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                   ("small", pa.list_(pa.int64()))])


def _signatures(n_words: int, m: int, k: int):
    """Set size, 128-bit hash of the set and the ``2 m`` small hashes of each document."""
    a = seeds(2 * m * k, 7)

    def run(batches):
        for rows, texts in slices(batches):
            x, first = shingles(texts, n_words)
            size = np.diff(first)
            full = np.flatnonzero(size)
            small = np.zeros((len(texts), 2 * m), dtype=U)
            s = np.zeros((2, len(texts)), dtype=U)
            if len(full):
                at = first[full]
                for i in range(2 * m):
                    h = np.full(len(full), i + 1, dtype=U)
                    for j in range(k):
                        y = x * a[i * k + j]
                        y ^= y >> U(32)
                        h = mix(h ^ np.minimum.reduceat(y * U(0xD6E8FEB86659FD93), at))
                    small[full, i] = h
                s[0, full] = np.add.reduceat(mix(x ^ a[0]), at)
                s[1, full] = np.bitwise_xor.reduceat(mix(x ^ a[1]), at)
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(np.where(size > 0, 2 * m, 0))]).astype(np.int32),
                small[full].ravel().view(np.int64))
            yield batch_of(_SETS, rows.column("doc_id"), size.astype(np.int64), s[0].view(np.int64),
                           s[1].view(np.int64), lists)
    return run


def _jaccard(n_words: int):
    """Intersection and set sizes of the two texts of each row."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("common", pa.int64()),
                        ("na", pa.int64()), ("nb", pa.int64())])

    def run(batches):
        for batch in batches:
            for rows, ta in slices([batch], "ta"):
                tb = rows.column("tb").cast(pa.binary()).to_pylist()
                xa, fa = shingles(ta, n_words)
                xb, fb = shingles(tb, n_words)
                # both sets of a row in one sorted run: neighbours that agree are common
                row = np.concatenate([np.repeat(np.arange(len(ta)), np.diff(fa)),
                                      np.repeat(np.arange(len(tb)), np.diff(fb))])
                x = np.concatenate([xa, xb])
                order = np.lexsort((x, row))
                x, row = x[order], row[order]
                same = (x[1:] == x[:-1]) & (row[1:] == row[:-1])
                common = np.bincount(row[1:][same], minlength=len(ta))
                yield batch_of(schema, rows.column("a"), rows.column("b"), common.astype(np.int64),
                               np.diff(fa).astype(np.int64), np.diff(fb).astype(np.int64))
    return run


def _sketches(n_words: int):
    """``SKETCH`` numbers for each document: a bit of each of 64 minima a number."""
    a = seeds(64 * SKETCH, 13)
    schema = pa.schema([("c", pa.int64()), *((f"k{j}", pa.int64()) for j in range(SKETCH))])

    def run(batches):
        for rows, texts in slices(batches):
            x, first = shingles(texts, n_words)
            full = np.flatnonzero(np.diff(first))
            out = np.zeros((SKETCH, len(full)), dtype=U)
            for i in range(64 * SKETCH if len(full) else 0):
                y = x * a[i]
                y ^= y >> U(32)
                least = np.minimum.reduceat(y * U(0xD6E8FEB86659FD93), first[full])
                out[i // 64] |= (mix(least) & U(1)) << U(i % 64)
            yield batch_of(schema, rows.column("doc_id").take(pa.array(full)), *out.view(np.int64))
    return run


def _enough(common: Column, na: Column, nb: Column, percent: int) -> Column:
    return common * 100 >= (na + nb - common) * percent


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n_words: int = 5, percent: int = PERCENT,
                    m: int = HASHES, k: int = MINIMA) -> DataFrame:
    """Components of documents linked by ``percent`` % Jaccard similarity of their
    sets of distinct ``n_words``-word shingles.

    Words are runs of non-white-space, A-Z lower-cased.  Returns one row per
    input row: ``doc_id, n_shingles, component_id, kept``; the component is the
    smallest id that links reach, and that document is kept.  A text without
    words (null, empty, white space) has an empty set and is linked with
    nothing; a shorter text has its whole sequence as its only shingle.  A row
    without id is its own component with a null id and is kept.  Rows repeating
    one id are one document: the id's component is that of all its texts.  An
    empty table gives an empty result; other columns are ignored.
    """
    base = id_text(docs, id_col, text_col)
    sets = stage(base.mapInArrow(_signatures(n_words, m, k),
                                 "doc_id long, n long, s1 long, s2 long, small array<long>"), "minhash-sets")
    full = sets.where("n > 0 AND doc_id IS NOT NULL")
    # 1. one class for each set; its smallest id stands for it
    classes = stage(full.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("c")), "minhash-classes")
    member = full.select("doc_id", "s1", "s2", "n").join(classes, ["s1", "s2", "n"]).select("doc_id", "c")
    # 2. small hashes that two classes share, combined to keys
    reps = full.join(classes.select("s1", "s2", "n", F.col("c").alias("doc_id")),
                     ["s1", "s2", "n", "doc_id"], "left_semi").dropDuplicates(["doc_id", "s1", "s2"])
    small = reps.select(F.col("doc_id").alias("c"), "n", F.posexplode("small").alias("i", "h"))
    shared = (small.groupBy("i", "h").agg(F.min("c").alias("x"), F.max("c").alias("y"))
              .where("x < y").select("i", "h"))
    halves = small.join(shared, ["i", "h"], "left_semi").groupBy("c", "n").agg(
        F.collect_list(F.when(F.col("i") < m, F.struct("i", "h"))).alias("p"),
        F.collect_list(F.when(F.col("i") >= m, F.struct("i", "h"))).alias("q"))
    keys = halves.select("c", "n", F.explode(F.flatten(F.transform("p", lambda x: F.transform(
        "q", lambda y: F.xxhash64(x["i"], y["i"], x["h"], y["h"]))))).alias("key"))
    slot = keys.groupBy("key").agg(F.min("c").alias("pivot"), F.max("c").alias("last")).where("pivot < last")
    keys = stage(keys.join(slot.select("key", "pivot"), "key"), "minhash-keys")
    # 3. each class against one pivot
    candidate = keys.select("c").distinct()
    texts = stage(base.join(candidate.withColumnRenamed("c", "doc_id"), "doc_id", "left_semi"), "minhash-texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        tested = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(
            _jaccard(n_words), "a long, b long, common long, na long, nb long")
        return tested.where(_enough(F.col("common"), F.col("na"), F.col("nb"), percent)).select("a", "b")

    pivots = keys.where("pivot < c").groupBy("c").agg(F.min("pivot").alias("a")).select("a", F.col("c").alias("b"))
    links = stage(confirm(pivots), "minhash-links")
    # 4. pairs of a common key in different components
    part = stage(components(links), "minhash-parts")
    placed = keys.join(part.withColumnRenamed("id", "c"), "c", "left").select(
        "key", "c", "n", F.coalesce("component", "c").alias("part"))
    sizes = placed.groupBy("key", "part").count()
    largest = (sizes.groupBy("key").agg(F.max_by("part", "count").alias("main"),
                                        F.min("part").alias("x"), F.max("part").alias("y"))
               .where("x < y").select("key", "main"))
    open_rows = stage(placed.join(largest, "key").groupBy("c", "n", "part").agg(
        F.max((F.col("part") != F.col("main")).cast("int")).alias("outside")), "minhash-open")
    ids = open_rows.select(F.col("c").alias("doc_id")).distinct()
    sketch = texts.join(ids, "doc_id", "left_semi").mapInArrow(
        _sketches(n_words), "c long, " + ", ".join(f"k{j} long" for j in range(SKETCH)))
    halves = reps.select(F.col("doc_id").alias("c"), "n", F.slice("small", 1, m).alias("halves"))
    rest = stage(open_rows.join(halves, ["c", "n"]).join(sketch, "c"), "minhash-rest")
    rest = rest.select("*", F.posexplode("halves").alias("i", "h"))
    own = [c for c in rest.columns if c not in ("i", "h")]
    left = rest.where("outside = 1").select("i", "h", *(F.col(c).alias(c + "_1") for c in own))
    right = rest.select("i", "h", *(F.col(c).alias(c + "_2") for c in own))
    apart = sum((F.bit_count(F.col(f"k{j}_1").bitwiseXOR(F.col(f"k{j}_2"))) for j in range(SKETCH)), F.lit(0))
    even = (1 + percent / 100) / 2
    most = int(64 * SKETCH * (1 - even) + SIGMAS * (64 * SKETCH * even * (1 - even)) ** 0.5)
    n1, n2 = F.col("n_1"), F.col("n_2")
    pairs = (left.join(right, ["i", "h"])
             .where((F.col("part_1") != F.col("part_2")) & (apart <= most)
                    & (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent)
                    & ((F.col("outside_2") == 0) | (F.col("c_1") < F.col("c_2")))
                    # of the small hashes that the two share, only the first
                    & (F.array_position(F.zip_with("halves_1", "halves_2", lambda x, y: x == y), True) == F.col("i") + 1))
             .select(F.least("c_1", "c_2").alias("a"), F.greatest("c_1", "c_2").alias("b")).distinct())
    more = stage(confirm(pairs), "minhash-more")
    found = components(links.unionByName(more)).withColumnRenamed("id", "c")
    # classes hold documents, and ids with several texts hold classes: join them over both
    placed = member.join(found, "c", "left").select("doc_id", F.coalesce("component", "c").alias("part"))
    several = placed.groupBy("doc_id").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    result = several.select("doc_id", F.col("p").alias("component_id"))
    bridges = several.where("p < q")
    bridges = stage(placed.join(bridges.select("doc_id", "p"), "doc_id").select(F.col("p").alias("a"), F.col("part").alias("b")),
                    "minhash-bridges")
    if not bridges.isEmpty():
        joined = components(bridges).select(F.col("id").alias("component_id"), F.col("component").alias("to"))
        result = result.join(joined, "component_id", "left").select(
            "doc_id", F.coalesce("to", "component_id").alias("component_id"))
    return sets.join(result, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"))
