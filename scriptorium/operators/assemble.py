"""Blocks of whole TeX texts, and the exercise records that their statements and proofs make.

Which slot a proof goes to depends on all blocks before it, so a text is folded as one value in an Arrow batch; texts are
independent, nothing is shuffled, and a task holds one batch. Null text counts as empty, and makes no rows. Blocks that aren't
closed are lost, as are ends without a start.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .equations import body_refs, each, kind_of, statement_index, tag_index

#: Patterns of sentinels, environments, numbers and references, and the kinds of blocks.
OPEN, CLOSE = re.compile(r"^\s*%<BLOCK\s+([^>]+)>\s*$"), re.compile(r"^\s*%</BLOCK>\s*$")
PAIR = re.compile(r'([A-Za-z_][A-Za-z0-9_]*)=("(?:\\.|[^"])*"|\S+)')
BEGIN, END = re.compile(r"^\s*\\begin\{(thm|proof)\}\s*$"), re.compile(r"^\s*\\end\{(thm|proof)\}\s*$")
EXERCISE = re.compile(r"(?i)\bExercise\s+(\d+(?:\.\d+)*)\b")
REF_ITEM = re.compile(r"(?i)^(theorem|thm|lemma|lem|algorithm|alg|proposition|prop|corollary|cor|definition|defn)\s*:\s*(\d+(?:\.\d+)*)$")
STATEMENT, PROOF, STATEMENT_PART, PROOF_PART, PART_PREFIX = "thm", "proof", "subpart_statement", "subpart_proof", "subpart_"


@dataclass
class Node:
    kind: str
    label: str
    attrs: dict[str, str]
    items: list = field(default_factory=list)  # lines and nodes

    def body(self) -> str:
        """The own lines, without those that begin or end an environment."""
        return _body(x for x in self.items if isinstance(x, str))

    def split(self, kind: str) -> tuple[str, list[Node]]:
        """The text beside the children of a kind, and these; other children stay in the text."""
        return _body(x.body() if isinstance(x, Node) else x for x in self.items if not _is(x, kind)), [x for x in self.items if _is(x, kind)]

    def attr(self, name: str) -> str:
        return self.attrs.get(name, "").strip()


def _is(x, kind: str) -> bool:
    return isinstance(x, Node) and x.kind == kind


def _body(pieces: Iterable[str]) -> str:
    return "\n".join(x for p in pieces for x in p.splitlines() or [""] if "\\" not in x or not BEGIN.match(x) and not END.match(x)).strip()


def opened(line: str) -> Node | None:
    """The empty node that a line opens; a header without a type opens none."""
    if "%<BLOCK" not in line or not (m := OPEN.match(line)):
        return None

    def value(v):
        v = v[1:-1] if v[0] == v[-1] == '"' else v
        return v.replace("\\n", "\n").replace('\\"', '"').replace("\\\\", "\\") if "\\" in v else v

    attrs = {k: value(v) for k, v in PAIR.findall(m[1])}
    kind = attrs.get("type", "").strip()
    return Node(kind, attrs.get("label", "").strip(), attrs) if kind else None


def nested(lines: Iterable[str], wanted: Callable[[str], bool]) -> list:
    """Lines and the closed top-level nodes among them; headers of kinds that aren't wanted are lines."""
    levels: list[list] = [[]]
    nodes: list[Node] = []
    for line in lines:
        if (node := opened(line)) and wanted(node.kind):
            nodes.append(node)
            levels.append(node.items)
        elif nodes and "%</BLOCK" in line and CLOSE.match(line):
            levels.pop()
            levels[-1].append(nodes.pop())
        else:
            levels[-1].append(line)
    return levels[0]


def sentinel_roots(s: str) -> list[Node]:
    return [x for x in nested(s.splitlines(), lambda _: True) if _is(x, STATEMENT) or _is(x, PROOF)]


def environment_roots(s: str) -> list[Node]:
    """Outermost thm and proof environments; one without an end runs to the end of the text."""
    out: list[Node] = []
    env, depth, held = "", 0, []

    def close():
        named = next((m for x in held if (m := EXERCISE.search(x))), None)
        label = "Proof" if env == PROOF else f"Exercise {named[1]}" if named else ""
        out.append(Node(env, label, {}, nested(held, lambda kind: kind.startswith(PART_PREFIX))))

    for line in s.splitlines():
        b, e = (BEGIN.match(line), END.match(line)) if "\\" in line else (None, None)
        if not depth:
            if b:
                env, depth, held = b[1], 1, []
            continue
        depth += bool(b and b[1] == env) - bool(e and e[1] == env)
        if depth:
            held.append(line)
        else:
            close()
    if depth:
        close()
    return out


def exercise_of(node: Node) -> str:
    m = EXERCISE.search(node.label) or EXERCISE.search(node.body())
    return m[1] if m else ""


def roots(s: str) -> list[Node]:
    """Sentinel blocks, with the environments of exercises that these lack; environments alone if sentinels are under 60 % of them, or under two."""
    marked, plain = sentinel_roots(s), environment_roots(s)
    if not plain:
        return marked
    if not marked or len(marked) < max(2, 3 * len(plain) // 5):
        return plain
    have = {exercise_of(n) for n in marked if n.kind == STATEMENT}
    taken, out = False, list(marked)
    for n in plain:  # proofs go with the statement before them
        if n.kind == STATEMENT:
            taken = (number := exercise_of(n)) != "" and number not in have
        if taken:
            out.append(n)
    return out


@dataclass
class Slot:
    problem: str = ""
    proof: str = ""
    refs: dict[str, None] = field(default_factory=dict)


def part_order(part: str) -> tuple:
    return len(part) != 1 or not part.isalpha(), part


def with_stem(stem: str, s: str) -> str:
    return s if s.startswith(stem) else f"{stem}\n\n{s}".strip() if stem else s


class Slots:
    """Slots by exercise and part, filled block by block."""

    def __init__(self):
        self.of: dict[str, dict[str, Slot]] = {}
        self.stems: dict[str, str] = {}
        self.waiting: dict[str, dict[str, None]] = {}  # parts with a statement that no untagged proof has taken, in order
        self.exercise = ""

    def slot(self, exercise: str, part: str) -> Slot:
        return self.of.setdefault(exercise, {}).setdefault(part, Slot())

    def open_parts(self, exercise: str, taken: Callable[[str, Slot], bool]) -> list[str]:
        """Parts with a statement that aren't taken, in order."""
        return sorted((p for p, x in self.of.get(exercise, {}).items() if p and x.problem and not taken(p, x)), key=part_order)

    def statement(self, node: Node) -> None:
        stem, parts = node.split(STATEMENT_PART)
        self.exercise = exercise = exercise_of(node) or next((e for x in parts if (e := x.attr("exercise"))), "") or self.exercise
        if exercise and len(stem) > len(self.stems.get(exercise, "")):
            self.stems[exercise] = stem
        for x in parts or [node]:
            own, part = (x.attr("exercise") or exercise, x.attr("part").lower()) if parts else (exercise, "")
            slot = self.slot(own, part)
            slot.problem = x.body()
            items = (REF_ITEM.match(r.strip()) for r in re.split("[;,]", x.attr("refs")))
            slot.refs |= {f"{kind_of(m[1])}:{m[2]}": None for m in items if m}
            if own and part:
                self.waiting.setdefault(own, {}).setdefault(part)

    def proof(self, node: Node) -> None:
        lead, parts = node.split(PROOF_PART)
        if not parts:  # the first part that waits, else the exercise itself
            waiting = self.waiting.get(self.exercise) if self.exercise else None
            part = next(iter(waiting)) if waiting else ""
            if waiting:
                del waiting[part]
            self.slot(self.exercise, part).proof = node.body()
            return
        seen: dict[str, set[str]] = {}
        for x in parts:
            exercise, part = x.attr("exercise") or self.exercise, x.attr("part").lower()
            if exercise and part and self.of.get(exercise, {}).get(part, Slot()).proof:  # a part named twice is one that has no proof yet
                part = next(iter(self.open_parts(exercise, lambda _, s: s.proof != "")), part)
            self.slot(exercise, part).proof = x.body()
            if exercise and part:
                seen.setdefault(exercise, set()).add(part)
        for exercise, done in seen.items() if lead else ():  # text before the parts proves (a), or the first part without a proof here
            free = self.open_parts(exercise, lambda p, _: p in done)
            if free:
                slot = self.slot(exercise, "a" if "a" in free else free[0])
                slot.proof = with_stem(lead, slot.proof)

    def rows(self):
        """(exercise, part, slot) in natural order."""

        def order(key):
            exercise, part = key[:2]
            return [int(x) if x.isdigit() else 10**9 for x in exercise.split(".")], 10**6 if not part else ord(part) - ord("a") if len(part) == 1 and part.isalpha() else 10**5, exercise, part

        return sorted(((e, p, x) for e, parts in self.of.items() for p, x in parts.items()), key=order)


def fold(s: str) -> Slots:
    out = Slots()
    for node in roots(s):
        (out.statement if node.kind == STATEMENT else out.proof)(node)
    return out


def record_slots(docs: DataFrame, **cols) -> DataFrame:
    """doc_id, index (from 1), exercise, part, problem, proof, raw_problem, raw_proof, theorem_refs, body_refs, unresolved, targets, statements.

    A part's problem begins with the text that its exercise's parts share. targets and statements are (display, content) of
    the references that resolve within the text itself.
    """

    def rule(s):
        slots = fold(s)
        if not slots.of:
            return []
        tags, known, out = tag_index(s), statement_index(s), []
        for k, (exercise, part, x) in enumerate(slots.rows()):
            refs, _, missing = body_refs(f"{x.problem}\n\n{x.proof}".strip(), tags, {})
            out.append({
                "index": k + 1, "exercise": exercise, "part": part, "raw_problem": x.problem, "proof": x.proof, "raw_proof": x.proof,
                "problem": with_stem(slots.stems.get(exercise, ""), x.problem) if exercise and part else x.problem,
                "theorem_refs": list(x.refs), "body_refs": refs, "unresolved": missing,
                "targets": [{"display": f"({t})", "content": tags[t]["equation"] or tags[t]["content"]} for t in refs],
                "statements": [{"display": known[t]["display"], "content": known[t]["content"]} for t in x.refs if t in known],
            })
        return out

    link = "array<struct<display: string, content: string>>"
    return each(docs, rule, f"index int, exercise string, part string, problem string, proof string, raw_problem string, raw_proof string, theorem_refs array<string>, body_refs array<string>, unresolved array<string>, targets {link}, statements {link}", **cols)
