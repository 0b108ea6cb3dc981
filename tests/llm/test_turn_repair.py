import heapq
import itertools
import random
import re
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from tests.llm.helpers import SF
from tidemark.llm import glr, queries, turn_repair

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(turns):
    """Least ``(cost, audit)`` and its turns, by Dijkstra over all edits of ``(role, fault)``."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(turns) and last in ("", "a"):
            return cost, audit, out
        for x in ("user", "assistant"):
            if (last, x[0]) in NEXT:
                heapq.heappush(heap, (cost + 5, audit + "I", i, x[0], (*out, (x, -1))))
        if i < len(turns):
            role, fault = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if fault not in ("b", "d"):
                more = 5 * (fault == "t")
                for x, letter, price in ((role, "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    if (last, x[:1]) in NEXT:
                        heapq.heappush(heap, (cost + price + more, audit + letter, i + 1, NEXT[last, x[:1]], (*out, (x, i))))


def kind_of(role, fault):
    known = role[:1] if role[:1] in ("s", "u", "a") and role else ""
    if fault in ("b", "d"):
        return "x"
    return (known.upper() or "_") if fault == "t" else known or "-"


def test_glr_by_dijkstra():
    r = glr.Repairer()
    roles, rng = ("system", "user", "assistant", "tool", ""), random.Random(5)
    short = [list(x) for n in range(4) for x in itertools.product(itertools.product(roles[:4], ("", "d", "t")), repeat=n)]
    long = [[(rng.choice(roles[:3] if rng.random() < 0.5 else roles), rng.choice(("", "", "", "b", "t")))
             for _ in range(rng.randint(4, 40))] for _ in range(600)]
    long += [[("user", "")] * 37, [("tool", "")] * 20 + [("system", ""), ("user", ""), ("assistant", "")],
             [("assistant", "t")] * 30, [("user", "d")] * 50]
    for turns in short + long:
        cost, audit, rows, new = r.repair("".join(kind_of(*t) for t in turns))
        want = cheapest(turns)
        assert (cost, audit) == want[:2], turns
        got = [(n or turns[i][0], i) for i, n in zip(rows, new, strict=True)]
        assert got == list(want[2]), turns
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x, _ in got))


def test_a_long_conversation_costs_one_lookup_a_turn():
    r = glr.Repairer()
    cost, audit, rows, _ = r.repair("uasx-U" * 50_000)
    assert len(audit) - audit.count("I") == 300_000 and len(rows) == len(audit) - audit.count("D")
    assert r.step.cache_info().misses < 200 and cost > 0


def brute(rows):
    """All result columns of each conversation from damaged ``(conv_id, turn, role, text)``."""
    out, white = {}, " \t\n\x0b\x0c\r"
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv and r[2] is not None),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in own:
            fault = ("b" if not text.strip(white) else "d" if (role, text) in seen
                     else "t" if text.rstrip(white)[-1] not in ".!?" else "")
            seen.add((role, text))
            turns.append((role, fault))
        numbers = [r[0] for r in own if r[0] is not None]
        cost, audit, kept = cheapest(turns)
        text = "\n".join(f"{role}:{own[i][2] if i >= 0 else ''}" for role, i in kept)
        initials = [r[:1] for r, _ in turns]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                     *(sum(f == x for _, f in turns) for x in "bdt"),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                     cost, audit, sha256(text.encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else x
        role, text = one(role), one(text)
        how = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if how == 0:
            out.append((conv, turn, None, None))
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def listed(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"],
                           r["repaired_sha256"]) for r in df.collect()}


def test_op11_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = listed(queries.op11_turn_repair(spark, SF))
    assert got == brute(damaged(rows)) and len(got) == len({r[0] for r in rows})


AWKWARD = [
    (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, None, None),
    (1, None, "user", "b."), (1, None, "user", "a."), (1, 3, "assistant", " \t\x0b"), (1, 3, "assistant", "x"),
    (2, 1, "", "No role."), (2, 2, "üser", "Odd!"), (2, 2, "System", "Odd?\r\n"), (2, 9, None, "z" * 200_000),
    (3, -4, "system", "S."), (3, 2, "user", "U. \n"), (3, 2, "user", "U. \n"), (3, 2, "user", "U. \n"), (3, 7, "assistant", "日本。"),
    (4, 5, "user", None), (5, None, "assistant", "é."),
    *[(6, i, "user", f"Again {i}.") for i in range(301)], *[(7, 0, "user", "Same.")] * 400,
    *[(8, i, ("user", "assistant")[i % 2], "Even.") for i in range(40)],
]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for c in ("t", "e", "fault", "kind", "initial", "cost", "__nth", "__how", "__copy", "__gone"):
        df = df.withColumn(c, F.lit(False) if c == "__gone" else F.lit("x"))
    return df


def digest(df):
    lines = F.transform("repaired", lambda t: F.concat_ws(":", t["role"], t["text"]))
    return df.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n").cast("binary"), 256))


def test_awkward_turns_by_brute_force(spark):
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in AWKWARD]
    out = digest(turn_repair.repair(frame(spark, AWKWARD)))
    assert listed(out) == brute(plain)
    assert {r["conv_id"]: r["n_turns"] for r in out.collect()}[7] == 400
    assert listed(digest(turn_repair.repair(turn_repair.damage(frame(spark, AWKWARD))))) == brute(damaged(AWKWARD))


def test_turns_gone_and_empty_tables(spark):
    empty = frame(spark, [])
    assert turn_repair.repair(empty).count() == turn_repair.repair(turn_repair.damage(empty)).count() == 0
    gone = frame(spark, AWKWARD).withColumn("__gone", F.lit(True))
    for r in turn_repair.repair(gone).collect():
        assert r["repaired"] == [] and r["audit"] == "" and r["cost"] == r["n_turns"] == r["gaps"] == r["illegal"] == 0


def test_plan_shuffles_turns_once(spark):
    plan = turn_repair.repair(frame(spark, AWKWARD).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(conv_id" in plan
