
from tidemark.operators import acl as A
from tidemark.operators.policy import resolve_policy

TABLES = ["crm.people", "crm.deals", "ledger.entries", "ledger.refunds", "web.visits_2024",
          "web.scratch_x", "ops.audit", "ops.vault"]


def resolve(spark, tables, **cfg):
    df = spark.createDataFrame([(t,) for t in tables], "table string")
    return {r["table"]: (r["included"], r["reason"], list(r["tags"]))
            for r in resolve_policy(df, **cfg).collect()}


def test_tags_and_policies(spark):
    r = resolve(spark, TABLES, exclude=["ops.vault"],
                tags={"private": ["crm.people", "ledger.*"], "sales": ["crm.*"],
                      "short_lived": ["*.visits_*", "web.scr?tch_[w-z]"]},
                policy={"private": "exclude", "short_lived": "exclude", "sales": "include"})
    assert r["ops.vault"] == (False, "explicit exclude", [])
    assert r["ledger.refunds"] == (False, "policy:private", ["private"])
    assert r["crm.people"] == (False, "policy:private", ["private", "sales"])
    assert r["web.scratch_x"] == (False, "policy:short_lived", ["short_lived"])
    assert r["crm.deals"] == (True, "", ["sales"])
    assert sorted(t for t, v in r.items() if v[0]) == ["crm.deals", "ops.audit"]


def test_untagged_excluded(spark):
    r = resolve(spark, ["public.a", "public.b"], tags={"approved": ["public.a"]},
                policy={"untagged": "exclude"})
    assert r["public.a"] == (True, "", ["approved"])
    assert r["public.b"] == (False, "policy:untagged", [])


def test_no_policy_and_exclusion_glob(spark):
    r = resolve(spark, ["public.a", "public.scratch_1"], tags={"t": ["public.*"]})
    assert all(v[0] for v in r.values())
    r = resolve(spark, ["public.a", "public.scratch_1", "public.[x]"],
                exclude=["*.scratch_*", "public.[x]"])
    assert r["public.scratch_1"][0] is False and r["public.a"][0] is True
    assert r["public.[x]"][0] is False      # exact name, not a glob


def test_reason_is_first_excluding_tag(spark):
    r = resolve(spark, ["s.t"], tags={"zeta": ["s.*"], "alpha": ["*.t"]},
                policy={"zeta": "exclude", "alpha": "exclude"})
    assert r["s.t"] == (False, "policy:alpha", ["alpha", "zeta"])


def test_role_profiles(spark):
    tg = spark.createDataFrame([
        ("analyst", "public", "orders", "SELECT"), ("analyst", "pg_catalog", "pg_class", "SELECT"),
        ("writer", "public", "orders", "INSERT"), ("other", "public", "orders", "SELECT")],
        "grantee string, table_schema string, table_name string, privilege_type string")
    cg = spark.createDataFrame([
        ("analyst", "public", "orders", "id", "SELECT"), ("analyst", "public", "users", "email", "SELECT"),
        ("analyst", "public", "users", "id", "SELECT"), ("writer", "public", "users", "id", "SELECT")],
        "grantee string, table_schema string, table_name string, column_name string, privilege_type string")
    p = {(r["role"], r["table"]): (r["all_columns"], r["columns"])
         for r in A.role_profiles(tg, cg, ["analyst", "writer"]).collect()}
    assert p == {("analyst", "public.orders"): (True, None),
                 ("analyst", "public.users"): (False, ["email", "id"]),
                 ("writer", "public.users"): (False, ["id"])}
    users = spark.createDataFrame([(1, "a@x", "pw")], "id int, email string, password string")
    prof = A.role_profiles(tg, cg, ["analyst", "writer"])
    assert A.role_view(users, prof, "writer", "public.users").columns == ["id"]


def test_membership_closure_with_cycle(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c")], "role string, member string")
    got = {(r["role"], r["member"]): r["depth"] for r in A.membership_closure(e).collect()}
    assert got[("b", "a")] == 1 and got[("c", "a")] == 2 and got[("a", "a")] == 3
    assert len(got) == 9


def test_internal_globs(spark):
    r = resolve(spark, ["dev.rollout_v2", "dev.revision", "public.orders"],
                tags={"internal": ["*.rollout*", "*.revision"]},
                policy={"internal": "exclude"})
    assert [t for t, v in sorted(r.items()) if v[0]] == ["public.orders"]
    assert r["dev.revision"][1] == "policy:internal"


def test_patterns_as_rows_by_brute_force(spark):
    import random
    import re

    from tidemark.functions.glob import glob_key, glob_to_regex
    from tidemark.operators.policy import match_patterns
    rng = random.Random(1)
    names = sorted({"".join(rng.choices("ab._", k=rng.randint(0, 9))) for _ in range(300)} | {"a.b_long_name_of_a_table", "é.ü", "a[b"})
    patterns = sorted({"".join(rng.choices(["a", "b", ".", "_", "*", "?", "[ab]", "[^a]", "\\*", "\\a"], k=rng.randint(0, 6)))
                       for _ in range(400)} | {"*", "", "??", "[", "a\\", "*long_name*", "*_of_a_tab*e", "é.*", "a[[]b", "*[a-]*"})
    want = sorted((n, p) for n in names for p in patterns
                  if glob_to_regex(p) != "a^" and re.match(glob_to_regex(p)[:-1] + r"\Z", n))
    t = spark.createDataFrame([(n, "x") for n in names], "table string, kind string")
    p = spark.createDataFrame([(p, 1) for p in patterns] + [(None, 1)], "pattern string, n int")
    out = match_patterns(t.select("table"), p)
    assert sorted((r["table"], r["pattern"]) for r in out.collect()) == want and len(want) > 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert match_patterns(t.select("table"), p.where("n = 2")).count() == 0
    assert glob_key("orders_[0-9]*") == ("ends", "orders_", "") and glob_key("x") == ("whole", "x", "")
    assert glob_key("*abcdefghij?") == ("inside", "abcdefgh", "") and glob_key("[") is None


def test_patterns_that_begin_alike_are_known_by_other_text(spark):
    from tidemark.operators.policy import _pattern_keys, match_patterns
    n = 300
    p = spark.createDataFrame([(f"crm.inv*_{i}[0-5]",) for i in range(n)], "pattern string")
    keys = _pattern_keys(p)
    assert keys.count() == keys.select("kind", "head", "tail").distinct().count() == n
    t = spark.createDataFrame([(f"crm.invoices_{i}",) for i in range(10 * n)], "table string")
    got = {(r["table"], r["pattern"]) for r in match_patterns(t, p).collect()}
    assert got == {(f"crm.invoices_{i}{j}", f"crm.inv*_{i}[0-5]") for i in range(n) for j in range(6)
                   if int(f"{i}{j}") < 10 * n and str(int(f"{i}{j}")) == f"{i}{j}"}


def test_no_side_of_patterns_as_rows_is_gathered_on_the_driver(spark):
    from tidemark.operators.policy import _pattern_keys, resolve_policy_rows
    t = spark.createDataFrame([(f"crm.{k}_{i}",) for i in range(40) for k in ("deals", "visits")], "table string")
    out = spark.createDataFrame([(f"crm.deals_{i}",) for i in range(0, 40, 4)] + [("crm.*_1?",)], "pattern string")
    tags = spark.createDataFrame([(f"t{i % 3}", f"crm.v*_{i}") for i in range(40)], "tag string, pattern string")
    decided = resolve_policy_rows(t, out, tags, {"t1": "exclude"})
    want = {}
    for i in range(40):
        gone = (False, "explicit exclude", [])
        want[f"crm.deals_{i}"] = gone if i % 4 == 0 or 10 <= i < 20 else (True, "", [])
        want[f"crm.visits_{i}"] = gone if 10 <= i < 20 else (i % 3 != 1, "policy:t1" if i % 3 == 1 else "", [f"t{i % 3}"])
    assert {r["table"]: (r["included"], r["reason"], list(r["tags"])) for r in decided.collect()} == want
    keys = _pattern_keys(tags)
    assert keys.count() == 40
    for frame in (decided, keys):       # these frames are small: by its estimates Spark would broadcast them
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_exclusions_and_tags_as_rows(spark):
    from tidemark.operators.policy import resolve_policy_rows
    t = spark.createDataFrame([(x,) for x in TABLES], "table string")
    out = spark.createDataFrame([("ops.vault",), ("*.scratch_*",), (None,)], "pattern string")
    tags = spark.createDataFrame([("sales", "crm.*"), ("sales", "*.deals"), ("private", "crm.p*"), (None, "ops.*"), ("x", "ops.vault")],
                                 "tag string, pattern string")
    got = {r["table"]: (r["included"], r["reason"], list(r["tags"]))
           for r in resolve_policy_rows(t, out, tags, {"private": "exclude", "untagged": "exclude"}).collect()}
    assert got["ops.vault"] == got["web.scratch_x"] == (False, "explicit exclude", [])
    assert got["crm.people"] == (False, "policy:private", ["private", "sales"])
    assert got["crm.deals"] == (True, "", ["sales"])
    assert got["ops.audit"] == (False, "policy:untagged", []) and len(got) == len(TABLES)


def test_effective_profiles_by_closure(spark):
    import random

    from tidemark.operators.acl import effective_profiles
    rng = random.Random(4)
    for case in range(4):
        roles = [f"r{i}" for i in range(12)]
        edges = {(rng.choice(roles), rng.choice(roles)) for _ in range((6, 14, 24, 0)[case])}
        tg = [(rng.choice([*roles, "PUBLIC"]), rng.choice(["public", "s", "pg_catalog"]), f"t{rng.randint(0, 4)}",
               rng.choice(["SELECT", "SELECT", "INSERT"])) for _ in range(12)]
        cg = [(rng.choice([*roles, "PUBLIC"]), rng.choice(["public", "s"]), f"t{rng.randint(0, 4)}", rng.choice("abc"), "SELECT")
              for _ in range(30)]
        allow = roles[:7] + ["stranger"]
        want = {}
        for r in allow:
            above, new = {r}, [r]
            while new:
                x = new.pop()
                for a, m in edges:
                    if m == x and a not in above:
                        above.add(a)
                        new.append(a)
            for g, s, t, p in tg:
                if g in above | {"PUBLIC"} and p == "SELECT" and s != "pg_catalog":
                    want[r, f"{s}.{t}"] = None
            for g, s, t, c, _ in cg:
                if g in above | {"PUBLIC"} and want.get((r, f"{s}.{t}"), ()) is not None:
                    want.setdefault((r, f"{s}.{t}"), set()).add(c)
        frames = [spark.createDataFrame(rows, schema) for rows, schema in (
            (tg, "grantee string, table_schema string, table_name string, privilege_type string"),
            (cg, "grantee string, table_schema string, table_name string, column_name string, privilege_type string"),
            (sorted(edges), "role string, member string"))]
        got = {(r["role"], r["table"]): None if r["all_columns"] else set(r["columns"])
               for r in effective_profiles(*frames, allow).collect()}
        assert got == want, case
        assert all(x["columns"] is None for x in effective_profiles(*frames, allow).where("all_columns").collect())
    assert effective_profiles(*frames, []).count() == 0
