"""Personal data by patterns and a skip-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card and phone numbers.  The
field then labels the tokens that look like data at all (a digit, ``@`` or
``+``, or a piece of an address found in the same text).  Its potentials:

* unary: a token's shape, with weights fitted on a bounded sample.  The patterns' spans
  are its examples of the kinds, and tokens unlike any kind those of "none".  A token
  that only looks like a kind, or is tied to a span, is no example: the patterns' silence is
  no label;
* chain: neighbouring tokens of one line tend to agree;
* skip: tokens anywhere in the text that are equal, or share their digits or an
  address's name part, agree.

Tokens inside a pattern's span are observed.  How strongly edges of either sort bind is
learned from the same sample, from how often the two ends of an edge between
spans are of one kind.

Loopy sum-product message passing spreads the labels over each text, so a card
number repeated without its grouping, or the name part of an address that
stands alone, gets the label of its distant partner.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, id_text, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

#: Fixed patterns of the four kinds.
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9.]+")

#: The commonest token shapes of the sample that the fit looks at.
MAX_SHAPES = 5_000
#: Documents the unary weights are fitted on, about.
TRAIN_DOCS = 5_000
#: Probability from which the field's label counts.
LEAST = 0.8
ROUNDS = 8
#: Bounds of what an edge may bind, as a log potential.
LEAST_BOND, MOST_BOND = 0.0, 5.0


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of what the patterns find, by kind, then start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:  # an address is what stands around an @: its name part reaches back as far as it can
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    for run in _NUMBERS.finditer(text):
        if run[0].count(".") >= 3:
            out += [("ip", *m.span()) for m in _IP.finditer(text, *run.span())
                    if all(len(p) <= 3 and int(p or "0") <= 255
                           for p in (x.lstrip("0") for x in m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


_TOKEN = re.compile(r"[^\s,;:!?\"'<>\[\]{}|]+")
_DATA = re.compile(r"[0-9@+]")


def _shape(token: str) -> tuple[float, ...]:
    """Features of a token: what it is made of."""
    digits = sum("0" <= c <= "9" for c in token)
    dots = token.count(".")
    name, _, rest = token.partition("@")
    return (1.0, float(bool(name and rest)), float(dots == 3 and digits >= 4), float(token[0] in "+("),
            float(digits >= 13), float(7 <= digits < 13), float(0 < digits < 7),
            digits / len(token), float(any(c.isalpha() for c in token)), float("-" in token or "(" in token))


_FEATURES = len(_shape("0"))


def _looks_like(shape: tuple[float, ...]) -> bool:
    """Does a token look like one of the kinds: an address, four numbers, a number with a
    sign or bracket before it, or a long one without letters?"""
    return bool(shape[1] or shape[2] or shape[3] or shape[4] and not shape[8])



@dataclass(frozen=True)
class Field:
    """Unary weights, and the log potentials of chain and skip edges."""

    weights: np.ndarray
    chain: float
    skip: float


def tokens_of(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, end, label)`` of the tokens the field looks at; label 0 is open.

    The spans found are one token each.  Others have a digit, ``@`` or ``+``, or
    are the name part of an address found here.
    """
    found = sorted((s, e, LABELS.index(k)) for k, s, e in base)
    taken, out, reach = [], [], -1
    for s, e, k in found:
        if s >= reach:
            out.append((s, e, k))
            taken.append((s, e))
            reach = e
    names = {text[s:e].split("@")[0].lower() for s, e, k in out if k == 1}
    places = []
    for m in _TOKEN.finditer(text):
        word = m[0].rstrip(".)")
        if _DATA.search(word) or len(word) >= 4 and word.lower() in names:
            places.append((m.start(), m.start() + len(word)))
    i = 0
    for s, e in places:
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if not (i < len(taken) and taken[i][0] < e):
            out.append((s, e, 0))
    return sorted(out)


def _partners(text: str, tokens: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Skip edges: tokens that are equal or similar, each to the one before of its kind
    and to the first, so a token that is repeated n times adds 2 n edges at most."""
    groups: dict[str, list[int]] = defaultdict(list)
    for i, (s, e, _) in enumerate(tokens):
        token = text[s:e].lower()
        digits = re.sub(r"[^0-9]", "", token)
        for key in {"=" + token, "#" + digits if len(digits) >= 8 else "", "@" + token.split("@")[0]
                    if len(token.split("@")[0]) >= 4 else ""}:
            if key:
                groups[key].append(i)
    edges = set()
    for members in groups.values():
        edges.update(pairwise(members))
        edges.update((members[0], m) for m in members[2:])
    return sorted(edges)


def _neighbours(text: str, tokens: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Chain edges: tokens that follow each other closely on a line."""
    return [(i, i + 1) for i in range(len(tokens) - 1) if "\n" not in text[tokens[i][1]:tokens[i + 1][0]]
            and tokens[i + 1][0] - tokens[i][1] < 40]


def field_labels(text: str, tokens: list[tuple[int, int, int]], field: Field) -> np.ndarray:
    """Marginal label probabilities of the tokens after loopy message passing."""
    size = len(LABELS)
    unary = np.array([_shape(text[s:e]) for s, e, _ in tokens]) @ field.weights.T
    unary -= unary.max(axis=1, keepdims=True)
    for i, (_, _, k) in enumerate(tokens):
        if k:  # observed
            unary[i] = -50.0
            unary[i, k] = 0.0
    skip, chain = _partners(text, tokens), _neighbours(text, tokens)
    edges = np.array(skip + chain, dtype=np.int64).reshape(-1, 2)
    if not len(edges):
        return np.exp(unary) / np.exp(unary).sum(axis=1, keepdims=True)
    agree = np.concatenate([np.full(len(skip), field.skip), np.full(len(chain), field.chain)])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    gain = np.expm1(np.concatenate([agree, agree]))[:, None]
    message = np.zeros((len(source), size))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        # the pairwise potential is 1 + gain where labels agree and 1 elsewhere
        new = np.log(out.sum(axis=1, keepdims=True) + gain * out)
        new -= new.max(axis=1, keepdims=True)
        message = 0.5 * message + 0.5 * new
    belief = unary.copy()
    np.add.at(belief, target, message)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def find(text: str, field: Field, least: float = LEAST) -> tuple[list, list]:
    """``(base, added)`` spans of a text."""
    base = base_spans(text)
    if not base and not _DATA.search(text):
        return base, []  # no token at all
    tokens = tokens_of(text, base)
    if all(k for _, _, k in tokens):
        return base, []
    p = field_labels(text, tokens, field)
    added = [(LABELS[b], s, e) for (s, e, k), row in zip(tokens, p, strict=True)
             if not k and (b := int(row.argmax())) and row[b] >= least]
    return base, added


def _examples(batches):
    """Shapes with their labels, and edges between spans: ``x`` is the sort of the edge (-1
    chain, -2 skip) and ``y`` whether its ends are of one kind."""
    schema = pa.schema([("x", pa.list_(pa.float64())), ("y", pa.int32())])
    for _, texts in slices(batches):
        x, y = [], []
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            tokens = tokens_of(text, base_spans(text))
            partners = _partners(text, tokens)
            linked = {i for edge in partners for i in edge if any(tokens[j][2] for j in edge)}
            for i, (s, e, k) in enumerate(tokens):
                shape = _shape(text[s:e])
                if k or i not in linked and not _looks_like(shape):
                    x.append(shape)
                    y.append(k)
            for sort, edges in ((-1.0, _neighbours(text, tokens)), (-2.0, partners)):
                for i, j in edges:
                    if tokens[i][2] and tokens[j][2]:
                        x.append((sort,))
                        y.append(int(tokens[i][2] == tokens[j][2]))
        yield batch_of(schema, x, y)


def _bond(agree: float, differ: float) -> float:
    """The log potential under which the two ends of an edge agree as often as seen, with
    one more of either."""
    bond = math.log((agree + 1) * (len(KINDS) - 1) / (differ + 1))
    return min(MOST_BOND, max(LEAST_BOND, bond))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        train_docs: int = TRAIN_DOCS) -> Field:
    """The field's weights from about ``train_docs`` documents chosen by a hash of their
    id: unary ones by multinomial logistic regression on token shapes, each label
    counting as much as any other, edges' by how often their ends agree.  Equal
    shapes are summed up first, so at most ``MAX_SHAPES`` counts come to the driver.
    A label without examples is never given."""
    base = id_text(docs, id_col, text_col)
    share = min(1.0, train_docs / max(1, base.count()))
    chosen = base.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(math.ceil(share * 1_000_000)))
    shapes = (chosen.mapInArrow(_examples, "x array<double>, y int")
              .select(F.transform("x", lambda v: F.round(v, 1)).alias("x"), "y")
              .groupBy("x", "y").count().orderBy(F.desc("count"), "x", "y").limit(MAX_SHAPES).collect())
    edges = {(int(r["x"][0]), r["y"]): r["count"] for r in shapes if len(r["x"]) == 1}
    chain, skip = (_bond(edges.get((sort, 1), 0), edges.get((sort, 0), 0)) for sort in (-1, -2))
    shapes = [r for r in shapes if len(r["x"]) > 1]
    weights = np.zeros((len(LABELS), _FEATURES))
    weights[0, 0] = 2.0  # without examples: nothing is personal data
    if not shapes:
        return Field(weights, chain, skip)
    x = np.array([r["x"] for r in shapes])
    y = np.array([r["y"] for r in shapes])
    n = np.array([r["count"] for r in shapes], dtype=float)
    n /= np.bincount(y, n, len(LABELS))[y] * len(set(y.tolist()))
    one_hot = np.eye(len(LABELS))[y]
    for _ in range(500):
        z = x @ weights.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights += 2.0 * (((one_hot - p) * n[:, None]).T @ x - 1e-4 * weights)
    return Field(weights, chain, skip)


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1], x[2])))


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text",
             least: float = LEAST) -> DataFrame:
    """``doc_id, base, added`` for each row: spans as ``array<struct<kind,start,end>>``
    in code points, end exclusive.

    ``base`` is what the patterns find, ``added`` what the field labels besides;
    the field never takes a base span away, and looks at every text with tokens,
    whether the patterns find anything there or not.
    Null text is empty; every row is on its own, whatever its id; other columns
    are ignored.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", span), ("added", span)])

    def run(batches):
        for rows, texts in slices(batches):
            found = [find(t.decode("utf-8", "replace"), field, least) for t in texts]
            base, added = ([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in f[i]] for f in found]
                           for i in (0, 1))
            yield batch_of(schema, rows.column("doc_id"), base, added)

    spans = "array<struct<kind:string,start:long,end:long>>"
    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, base {spans}, added {spans}")
