"""Spelling variants: words that differ by one inserted, deleted or replaced
code point, and the form that each is a variant of.

The join is asymmetric.  The shorter word of a pair (of equal ones, either) is
cut into two disjoint chunks, its halves; the longer gives its positional grams
of the same lengths.  One edit leaves a half whole, at most one place further
along, so the half that holds the edit is cut into two chunks again, of which one
is whole too.  A key is thus a word less one quarter: three quarters of the word in
their places.  The quarters left out are then compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, stage

#: Fewest code points and occurrences of a word, and how many times as frequent its form must be.
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10
#: One run in so many loses a code point (``damaged``).
EVERY = 31
LETTERS = r"A-Za-zÀ-ÿ"


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1) -> DataFrame:
    """``(doc_id, run)`` for each maximal run of at least ``least`` letters, A-Z lower-cased."""
    found = id_text(docs, id_col, text_col).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("run"))
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return found.select("doc_id", F.when(F.col("run").rlike("[A-Z]"), lower).otherwise(F.col("run")).alias("run"))


def damaged(found: DataFrame) -> DataFrame:
    """``(word)``: runs, where the CRC-32 of ``doc_id:run`` divides by ``EVERY`` less
    the code point that it names.  A null id counts as empty."""
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("run")).cast("binary"))
    out = found.withColumn("h", h).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    cut = F.concat(F.substring(F.col("run"), F.lit(1), F.col("at")),
                   F.substring(F.col("run"), F.col("at") + 2, F.length("run")))
    return out.select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough; summed up on the map side."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def _quarters(length: Column) -> list[tuple[Column, Column]]:
    """Start and end of each quarter of a word of ``length``: the halves' halves."""
    half, rest = F.floor(length / 2), length - F.floor(length / 2)
    cuts = [F.lit(0), F.floor(half / 2), half, half + F.floor(rest / 2), length]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _keys(words: DataFrame, shift: int) -> DataFrame:
    """``(key, word, n, quarter, last)``: a word in place of one that is ``shift`` shorter,
    without each of that one's quarters in turn."""
    length = F.length("word") - shift
    keys = []
    for i, (start, end) in enumerate(_quarters(length)):
        start, end = start.cast("int"), end.cast("int") + shift
        word = F.col("word")
        keys.append(F.struct(
            # length and quarter number keep apart what only looks alike
            F.concat(length.cast("string"), F.lit(f"/{i}/"), F.substring(word, F.lit(1), start),
                     F.substring(word, end + 1, F.length(word))).alias("key"),
            F.substring(word, start + 1, end - start).alias("quarter"), F.lit(i == 3).alias("last")))
    return words.select("word", "n", F.inline(F.array(*keys)))


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: each unordered pair of near words once.  ``words`` has
    distinct words of at least four code points as ``word``, with counts ``n``."""
    def side(shift: int, name: str) -> DataFrame:
        return _keys(words, shift).select("key", *(F.col(c).alias(f"{d}{name}") for c, d in (
            ("word", ""), ("n", "n_"), ("quarter", "q_"), ("last", "last_"))))

    def joined(shift: int, wanted: Column) -> DataFrame:
        # with no shift both sides are one shuffle
        return (side(0, "a").join(side(shift, "b"), "key").where(wanted & (F.levenshtein("q_a", "q_b", 1) == 1))
                .select("a", "n_a", "b", "n_b"))

    # A replaced code point is in one quarter.  An inserted one may count for two (aab, aaab):
    # the last place that it can have decides.
    inserted = F.col("last_a") | ~F.startswith("q_b", "q_a")
    return joined(0, F.col("a") < F.col("b")).unionByName(joined(1, inserted))


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` for each of ``words`` (as for ``near_pairs``)."""
    pairs = near_pairs(words)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")))
    near = (pairs.select(F.inline(sides)).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), "near")).alias("best")))
    out = words.join(near, "word", "left")
    good = -F.col("best.minus") >= times * F.col("n")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                      F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.minus")).alias("form_n"))


def roots(linked: DataFrame) -> DataFrame:
    """``(word, root)`` for each row of ``linked`` (``word, form``) that has a form: the
    end of the chain of forms.  Pointers jump, so rounds grow with the logarithm of
    a chain's length; that is at most the number of digits of the largest count."""
    at = stage(linked.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, times: int = TIMES, change=None) -> DataFrame:
    """Group the spelling variants of the words of all texts: ``word, form, root, n,
    n_near, form_n`` for each distinct word of at least ``least_length`` (four or
    more) code points and ``least_count`` occurrences.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased;
    ``change`` may turn ``(doc_id, run)`` into ``(word)``, none of them longer, before words are counted.
    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  ``form`` is the near word with the largest count (of
    equal ones, the first in code-point order) if that is at least ``times`` the
    word's own, else null; ``root`` is where following the forms ends, the word
    itself without one.

    Null and empty texts have no words.  Rows that repeat, an id or a text, count
    each.  A text of any length is taken whole.  An empty table gives an empty
    result; other columns are ignored.
    """
    if least_length < 4:
        raise ValueError("words of fewer than four code points have no quarters")
    # a change may shorten a run, so no shorter one makes a word
    found = runs(docs, id_col, text_col, least_length)
    words = stage(count_words(change(found) if change else found.select(F.col("run").alias("word")),
                              least_length, least_count), "spelling-words")
    linked = stage(forms(words, times), "spelling-forms")
    return (linked.join(roots(linked), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
