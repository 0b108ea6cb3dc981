"""Cheapest repair of a sequence of roles by generalised LR parsing.

The tables of the role grammar are made once, by the SLR rule.  A parse keeps a
graph-structured stack: a node is an LR state on top of another node, equal
stacks are one node, and every turn moves all tops at once, with the actions
*keep*, *rerole*, *delete* and *insert*.  Of the ways to one top only the least
``(cost, audit)`` lives on.

Tops are ordered by their audits, and no audit of a top is the beginning of
another's (each ends with the action on the same turn), so a comparison needs
their ranks and the latest letters only.  What a kind of turn does to a set of
tops is worked out once; a turn then costs one lookup, and a conversation one
reference a turn, however long it is.
"""

from __future__ import annotations

from functools import cache, lru_cache

#: A conversation is empty, or pairs of user and assistant after at most one system turn.
GRAMMAR = (("talk", ()), ("talk", ("pairs",)), ("talk", ("s", "pairs")),
           ("pairs", ("u", "a")), ("pairs", ("pairs", "u", "a")))
END = "$"
#: Costs of the actions.  An undeleted truncated turn costs ``TRUNCATED`` more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Any top gets where another could go on for two inserts and one deletion, so
#: one that is dearer than the cheapest by more than this can't win any more.
SLACK = 2 * INSERT + DELETE
#: Steps that a worker remembers.
KNOWN_STEPS = 1 << 17
#: Kinds of turns: the initial of a role, upper-case if truncated, or one of these.
MUST_GO, OTHER, OTHER_TRUNCATED = "x", "-", "_"


class Tables:
    """SLR(1) tables: ``shift[state, symbol]`` and ``reduce[state, symbol]``, which
    lists rules (a conflict leaves several, and a parse follows all)."""

    def __init__(self, rules=GRAMMAR):
        self.rules = rules
        self.heads = {head for head, _ in rules}
        symbols = {x for _, body in rules for x in body} | self.heads
        follow = self._follow()
        states = [self._closure({(None, 0)})]
        self.shift: dict[tuple[int, str], int] = {}
        for n, items in enumerate(states):  # grows while it is walked
            for x in sorted(symbols):
                moved = {(r, dot + 1) for r, dot in items if self._next(r, dot) == x}
                if moved:
                    to = self._closure(moved)
                    if to not in states:
                        states.append(to)
                    self.shift[n, x] = states.index(to)
        self.reduce: dict[tuple[int, str], list[int]] = {}
        for n, items in enumerate(states):
            for r, dot in sorted((i for i in items if i[0] is not None), key=str):
                if dot == len(rules[r][1]):
                    for x in follow[rules[r][0]]:
                        self.reduce.setdefault((n, x), []).append(r)

        #: The rule of each state that can do nothing but reduce by it.
        self.sure: dict[int, int] = {}
        for (n, _), found in self.reduce.items():
            whole = {i for i in states[n] if i[0] is not None and i[1] == len(rules[i[0]][1])}
            if len(whole) == len(states[n]) == 1 and rules[found[0]][0] != rules[0][0]:
                self.sure[n] = found[0]

    def _body(self, rule):
        return (self.rules[0][0],) if rule is None else self.rules[rule][1]

    def _next(self, rule, dot):
        body = self._body(rule)
        return body[dot] if dot < len(body) else None

    def _closure(self, items):
        items = set(items)
        while more := {(i, 0) for r, dot in items for i, (head, _) in enumerate(self.rules)
                       if head == self._next(r, dot)} - items:
            items |= more
        return frozenset(items)

    def _first(self, body, first):
        out = set()
        for x in body:
            out |= first.get(x, {x}) - {""}
            if "" not in first.get(x, {x}):
                return out
        return out | {""}

    def _follow(self):
        first = {h: set() for h in self.heads}
        follow = {h: set() for h in self.heads}
        follow[self.rules[0][0]].add(END)
        size = -1
        while size != (size := sum(map(len, (*first.values(), *follow.values())))):
            for head, body in self.rules:
                first[head] |= self._first(body, first)
                for i, x in enumerate(body):
                    if x in self.heads:
                        rest = self._first(body[i + 1:], first)
                        follow[x] |= rest - {""} | (follow[head] if "" in rest else set())
        return follow


class Repairer:
    """Repairs conversations given as one character per turn (see ``MUST_GO`` and its like)."""

    ROLES = {"u": "user", "a": "assistant"}  # what a turn can be made or inserted as

    def __init__(self):
        self.tables = Tables()
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # LR state, node below
        self.known = {(0, -1): 0}
        self.advance = cache(self._advance)
        self.step = lru_cache(KNOWN_STEPS)(self._step)
        self.finish = lru_cache(KNOWN_STEPS)(self._finish)

    def _push(self, below: int, state: int) -> int:
        node = (state, below)
        if node not in self.known:
            self.known[node] = len(self.nodes)
            self.nodes.append(node)
        return self.known[node]

    def _reduce(self, node: int, rule: int) -> int:
        head, body = self.tables.rules[rule]
        for _ in body:
            node = self.nodes[node][1]
        return self._push(node, self.tables.shift[self.nodes[node][0], head])

    def _ready(self, node: int, symbol: str) -> list[int]:
        """The tops after all reductions that ``symbol`` allows, with ``node`` itself."""
        out = [node]
        for top in out:  # grows while it is walked
            for rule in self.tables.reduce.get((self.nodes[top][0], symbol), ()):
                if (n := self._reduce(top, rule)) not in out:
                    out.append(n)
        return out

    def _settled(self, node: int) -> int:
        """``node`` after the reductions that whatever comes can't change: stacks
        that mean the same become equal."""
        while (rule := self.tables.sure.get(self.nodes[node][0])) is not None:
            node = self._reduce(node, rule)
        return node

    def _advance(self, node: int, symbol: str) -> tuple[int, ...]:
        """The tops after shifting ``symbol``."""
        return tuple(self._settled(self._push(n, self.tables.shift[self.nodes[n][0], symbol]))
                     for n in self._ready(node, symbol) if (self.nodes[n][0], symbol) in self.tables.shift)

    def _accepts(self, node: int) -> bool:
        goal = self.tables.shift[0, self.tables.rules[0][0]]
        return any(self.nodes[n] == (goal, 0) for n in self._ready(node, END))

    def _inserted(self, tops):
        """Every top that inserts reach, with its least ``(cost, rank, letters, roles)``."""
        best = {node: (cost, i, "", ()) for i, (node, cost) in enumerate(tops)}
        todo = list(best)
        for node in todo:  # grows while it is walked
            cost, i, letters, roles = best[node]
            for x in self.ROLES:
                way = (cost + INSERT, i, letters + "I", (*roles, x))
                for to in self.advance(node, x):
                    if to not in best or way[:3] < best[to][:3]:
                        best[to] = way
                        todo.append(to)
        return best

    def _step(self, tops, kind: str):
        """``tops`` (node and cost, by rank) after one more turn: the new tops, with
        costs above the least, that least, and for each the rank it comes from
        and its ``(letter, new role or None)`` actions."""
        found: dict[int, tuple] = {}

        def offer(node, cost, rank, letters, roles):
            if node not in found or (cost, rank, letters) < found[node][:3]:
                found[node] = (cost, rank, letters, roles)

        extra = TRUNCATED if kind.isupper() or kind == OTHER_TRUNCATED else 0
        for node, (cost, rank, letters, roles) in self._inserted(tops).items():
            offer(node, cost + DELETE, rank, letters + "D", (*roles, None))
            if kind == MUST_GO:
                continue
            for to in self.advance(node, kind.lower()):
                offer(to, cost + KEEP + extra, rank, letters + "K", (*roles, None))
            for x in self.ROLES:
                for to in self.advance(node, x):
                    offer(to, cost + REROLE + extra, rank, letters + "R", (*roles, x))
        least = min(way[0] for way in found.values())
        alive = sorted(((rank, letters, cost - least, node, roles)
                        for node, (cost, rank, letters, roles) in found.items() if cost <= least + SLACK))
        return (tuple((node, cost) for _, _, cost, node, _ in alive), least,
                tuple((rank, tuple(zip(letters, roles, strict=True))) for rank, letters, _, _, roles in alive))

    def _finish(self, tops):
        """Cost, rank and last actions of the best accepted top."""
        cost, rank, letters, roles = min(way for node, way in self._inserted(tops).items() if self._accepts(node))
        return cost, rank, tuple(zip(letters, roles, strict=True))

    def repair(self, kinds: str) -> tuple[int, str, list[int], list[str | None]]:
        """Cost, audit, and the repaired turns: the place of each in the input
        (-1: inserted) and its new role (``None``: its own)."""
        tops, total, back = ((0, 0),), 0, []
        for kind in kinds:
            tops, cost, arrows = self.step(tops, kind)
            total += cost
            back.append(arrows)
        cost, rank, actions = self.finish(tops)
        parts = [actions]
        for arrows in reversed(back):
            rank, actions = arrows[rank]
            parts.append(actions)
        letters, rows, roles, at = [], [], [], 0
        for actions in reversed(parts):
            for letter, role in actions:
                letters.append(letter)
                if letter != "D":
                    rows.append(-1 if letter == "I" else at)
                    roles.append(self.ROLES.get(role))
                at += letter != "I"
        return total + cost, "".join(letters), rows, roles
