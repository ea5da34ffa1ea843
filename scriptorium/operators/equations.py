"""Indexes of equations and statements of whole documents, the references to them, and their expansion.

Everything here needs positions, back references or a fold, so each operator is one pass of Arrow batches over rows of
(id, text); a task holds a batch, and nothing is shuffled. Null text counts as empty; a null id is passed on.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns of tags, displays, references and attributes, and the ordinals of depth.
TAG, ANY_TAG = re.compile(r"\\tag\{([^}]+)\}"), re.compile(r"\\tag\*?\{[^}]*\}")
BRACKETS, DOLLARS = re.compile(r"(?s)\\\[.*?\\\]"), re.compile(r"(?s)\$\$.*?\$\$")
ENVIRONMENT = re.compile(r"(?s)\\begin\{(?P<env>equation\*?|align\*?|gather\*?|multline\*?)\}.*?\\end\{(?P=env)\}")
DISPLAY = re.compile(r"(?s)(?<!\\)\$\$.*?\$\$|(?<!\\)\\\[.*?\\\]|\\begin\{(?P<env>(?:equation|align|gather|multline|flalign)\*?)\}.*?\\end\{(?P=env)\}")
MANUAL = re.compile(r"\(\s*(\d+\.\d+(?:\.\d+)*(?:[A-Za-z])?)\s*\)")
TAIL_NUMBER = re.compile(r"(?s)^(.*?)(?:(?:\s*(?:\\qquad|\\quad|\\hfill)\s*)+|\s+)\((\d+(?:\.\d+)*(?:[A-Za-z])?)\)\s*$")
ALONE, FENCE, FENCE_NUMBER = re.compile(r"^\s*\((\d+(?:\.\d+)*(?:[A-Za-z])?)\)\s*$"), re.compile(r"^\s*\$\$\s*$"), re.compile(r"^\(\s*\d+(?:\.\d+)*\s*\)$")
ORIGIN = re.compile(r"(?ms)^%<BLOCK\s+([^>]*\btype=origintext\b[^>]*)>\s*\n(.*?)\n%</BLOCK>\s*")
LABEL = re.compile(r'\blabel=("(?:\\.|[^"])*"|\S+)')
STATEMENT = re.compile(r"(?i)\b(Theorem|Thm\.?|Lemma|Lem\.?|Algorithm|Alg\.?)\s+(\d+(?:\.\d+)*)\b")
EQUATION_REF = re.compile(r"\(\s*(\d+(?:\.\d+)*(?:[A-Za-z])?)\s*\)")
STATEMENT_REF = re.compile(r"(?i)\b(Theorem|Thm\.?|Lemma|Lem\.?|Algorithm|Alg\.?|Proposition|Prop\.?|Corollary|Cor\.?|Definition|Defn\.?)\s+(\d+(?:\.\d+)*)\b")
PHRASE_REF = re.compile(r"(?i)(?<!\\)\b(?:Eq\.|Eqs\.|Equation|Equations|problem|constraint|update|formula|model)\s*\(\s*(\d+(?:\.\d+)*(?:[A-Za-z])?)\s*\)")
RANGE_REF = re.compile(r"(?i)\((\d+(?:\.\d+)*)([A-Za-z])\)\s*(?:--|-|to|~)\s*\((\d+(?:\.\d+)*)([A-Za-z])\)")
PLAIN_REF = re.compile(r"\((\d+(?:\.\d+)*(?:[A-Za-z])?)\)")
DEPTHS = ["double", "third", "fourth", "fifth", "sixth", "seventh", "eighth"]
REACH = 240
# Compiled here, since a text meets each of these often.
BETWEEN_BRACKETS, ALIGNED, ALIGN = re.compile(r"(?s)\\\[(.*)\\\]"), re.compile(r"(?s)\\begin\{aligned\}(.*?)\\end\{aligned\}"), re.compile(r"(?s)\\begin\{align\*?\}(.*)\\end\{align\*?\}")
NEW_ROW, TAG_VALUE, LETTERED, LETTER = re.compile(r"\\\\\s*"), re.compile(r"\\tag\*?\{([^}]*)\}"), re.compile(r"(\d+\.\d+(?:\.\d+)*)[A-Za-z]"), re.compile(r"\\(?:mathrm|text|textrm)\{\s*([A-Za-z])\s*\}")
PLAIN_MARKS = str.maketrans("（）–—", "()--")


def squeezed(s: str) -> str:
    return " ".join(s.split())


def token(s: str) -> str:
    return "".join(s.strip().strip("()[]").split())


def kind_of(word: str) -> str:
    t = word.strip().lower().rstrip(".")
    return "lemma" if t in ("lemma", "lem") else "algorithm" if t in ("algorithm", "alg") else "theorem"


def displays(s: str) -> list[tuple[int, int]]:
    """Spans of the three families of displays in order, each once; overlapping ones stay."""
    return sorted({m.span() for p in (BRACKETS, DOLLARS, ENVIRONMENT) for m in p.finditer(s)})


def rows_of(s: str) -> list[str]:
    return [r for r in map(str.strip, NEW_ROW.split(s)) if r]


def preview(block: str) -> str:
    """A display for reading: brackets with several numbers become align* with a tag in each row.

    A number written by hand at a row's end comes back behind two backslashes, as results of this rule have it.
    """
    b = block.strip()
    if not (m := BETWEEN_BRACKETS.fullmatch(b)):
        return b
    inner = m[1].strip()
    tags = ANY_TAG.findall(inner)

    def tagged(rows):
        for k, row in enumerate(rows):
            cut = TAIL_NUMBER.match(row)
            tag = tags[k] if k < len(tags) else rf"\\tag{{{cut[2]}}}" if cut else ""
            yield f"{cut[1].rstrip() if cut else row} {tag}".strip(), tag

    aligned = ALIGNED.search(inner)
    found = list(tagged(ANY_TAG.sub("", r).strip() for r in rows_of(aligned[1]))) if aligned else []
    if not any(t for _, t in found):
        found = list(tagged(rows_of(ANY_TAG.sub("", inner).strip()))) if len(tags) > 1 else []
    return "\\begin{align*}\n" + " \\\\\n".join(r for r, _ in found) + "\n\\end{align*}" if found else b


def row_of_tag(block: str, tag: str) -> str:
    """The row of an align display that has the tag, as a display of its own; other displays whole."""
    m = ALIGN.fullmatch(block)
    own = [r for r in rows_of(m[1]) if any(x.strip() == tag for x in TAG_VALUE.findall(r))] if m else []
    return "\\begin{align*}\n" + own[0] + "\n\\end{align*}" if own else block


def tag_index(s: str) -> dict[str, dict]:
    """Each tag's first place: its surroundings, and the first display that holds it (brackets before environments)."""
    if "\\tag{" not in s:
        return {}
    block: dict[str, str] = {}
    for p in (BRACKETS, ENVIRONMENT):
        own: dict[str, str] = {}
        for m in p.finditer(s):
            for t in TAG.findall(m[0]):
                own.setdefault(t.strip(), m[0].strip())
        block = own | block
    out: dict[str, dict] = {}
    for m in TAG.finditer(s):
        if (t := token(m[1])) and t not in out:
            full = preview(block.get(t, ""))
            near = squeezed(s[max(0, m.start() - REACH) : m.start() + REACH])
            out[t] = {"content": near, "equation": row_of_tag(full, t), "equation_full": full, "position": m.start()}
    return out


def fallback_index(s: str) -> dict[str, dict]:
    """Numbers of displays where a text has no tags of its own; a display's tags win over numbers written by hand.

    A number with a letter also stands for the number alone. A number of several different displays is dropped.
    """
    s, found = s.replace("（", "(").replace("）", ")"), {}
    for lo, hi in displays(s):
        block = s[lo:hi].strip()
        own = [t for t in map(token, TAG.findall(block))] or [token(x) for x in MANUAL.findall(block)]
        own += [m[1] for t in own if (m := LETTERED.fullmatch(t))]
        full = preview(block)
        key = "\n".join(x.rstrip() for x in full.splitlines()).strip()
        for t in dict.fromkeys(t for t in own if t):
            found.setdefault(t, {}).setdefault(key, {"content": squeezed(block), "equation": full, "equation_full": full, "position": lo})
    return {t: next(iter(x.values())) for t, x in found.items() if len(x) == 1}


def statement_index(s: str) -> dict[str, dict]:
    """Statements of origintext blocks by kind:number, from the label or else the first six lines; the first of a key counts."""
    out: dict[str, dict] = {}
    for m in ORIGIN.finditer(s) if "origintext" in s else ():
        body, label = m[2].strip(), LABEL.search(m[1])
        found = STATEMENT.search(label[1].strip('"').replace('\\"', '"') if label else "") or STATEMENT.search("\n".join(body.splitlines()[:6]))
        if found and (key := f"{kind_of(found[1])}:{found[2]}") not in out:
            out[key] = {"display": f"{kind_of(found[1]).title()} {found[2]}", "content": squeezed(body)}
    return out


def body_refs(s: str, known, by_base: dict[str, list[str]]) -> tuple[list[str], dict[str, str], list[str]]:
    """References that resolve, in order: after a word for equations, ranges, then any in brackets; what each was found by; what doesn't resolve.

    by_base: numbers of the fallback index with a letter, by the number alone, which stand in for one that is missing.
    """
    if "(" not in s and "（" not in s:
        return [], {}, []
    s = LETTER.sub(r"\1", s).translate(PLAIN_MARKS)
    asked = [(m[1], m[0]) for m in PHRASE_REF.finditer(s)]
    for m in RANGE_REF.finditer(s):
        a, b = ord(m[2].lower()), ord(m[4].lower())
        if m[1] == m[3]:
            asked += [(f"{m[1]}{chr(x)}", m[0]) for x in (range(a, b + 1) if a <= b else range(a, b - 1, -1))]
    asked += [(m[1], m[0]) for m in PLAIN_REF.finditer(s)]
    found: dict[str, str] = {}
    missing: dict[str, None] = {}
    for t, by in asked:
        if t in found:
            continue
        stand_in = [t] if t in known else by_base.get(t, [])
        for x in stand_in:
            found.setdefault(x, by.strip())
        if not stand_in:
            missing[t] = None
    return list(found), found, list(missing)


def found_refs(s: str, tags, statements) -> tuple[list[str], list[str]]:
    """References of a text that resolve, each list by place: equations, statements."""
    eq = [t for x in EQUATION_REF.findall(s) if (t := token(x)) in tags] if tags else []
    return eq, [k for word, number in STATEMENT_REF.findall(s) if (k := f"{kind_of(word)}:{number}") in statements] if statements else []


def resolvable(s: str, tags, statements) -> list[str]:
    """References of a text that resolve: equations by place, then statements."""
    eq, more = found_refs(s, tags, statements)
    return list(dict.fromkeys(eq + more))


def expand(s: str, tags: dict[str, dict], statements: dict[str, dict], most: int = 5, insert: Callable[[str, str, str], str] | None = None) -> tuple[str, list[str]]:
    """The text with the contents of its references, and theirs, and notes on depth and cycles.

    After each insertion all that is open by then is resolved one level deeper, each key once; depth falls again when a level is done.
    What is put at the end, in brackets of its own, shares no reference with the text before it, and is the only part that is searched anew.
    """
    seen: set[str] = set()
    notes: list[str] = []
    def resolve(key):
        if key in tags:
            return f"({key})", (tags[key]["equation"] or tags[key]["content"]).strip()
        return statements[key]["display"], statements[key]["content"].strip()

    def level(at: tuple, depth: int) -> tuple:
        for key in dict.fromkeys(at[1] + at[2]):
            if key in seen:
                continue
            seen.add(key)
            shown, content = resolve(key)
            if not content:
                continue
            if depth:
                notes.append(f"{DEPTHS[depth - 1] if depth <= len(DEPTHS) else f'level-{depth + 1}'} reference + {shown}")
            if insert:
                text = insert(at[0], shown, content)
                at = text, *found_refs(text, tags, statements)
            else:
                more = f"\n\n[{shown}: {content}]"
                eq, st = found_refs(more, tags, statements)
                at = at[0] + more, at[1] + eq, at[2] + st
            notes.extend(f"Cyclic reference detected: {resolve(k)[0]} (in expansion of {shown})" for k in resolvable(content, tags, statements) if k in seen)
            at = deeper(at, depth)
        return deeper(at, depth)

    def deeper(at: tuple, depth: int) -> tuple:
        return level(at, depth + 1) if depth < most and not (seen.issuperset(at[1]) and seen.issuperset(at[2])) else at

    return level((s, *found_refs(s, tags, statements)), 0)[0], notes


def split_displays(s: str) -> list[tuple[str, str]]:
    """Alternating (kind, text) of text and math."""
    out, at = [], 0
    for m in DISPLAY.finditer(s):
        out += [("text", s[at : m.start()])] * (m.start() > at) + [("math", m[0])]
        at = m.end()
    return out + [("text", s[at:])] * (at < len(s))


def inner_of(block: str) -> str:
    """A display's formula without delimiters, tags and one aligned around it."""
    b = block.strip()
    m = re.fullmatch(r"(?s)\$\$(.*?)\$\$|\\\[(.*?)\\\]|\\begin\{(?P<e>(?:equation|gather|multline|flalign|align)\*?)\}(.*)\\end\{(?P=e)\}", b)
    inner = ANY_TAG.sub("", next((m[k] for k in (1, 2, 4) if m[k] is not None), "") if m else b).strip()
    m = re.fullmatch(r"(?s)\\begin\{aligned\}(.*?)\\end\{aligned\}", inner)
    return m[1].strip() if m else inner


def merge_displays(blocks: list[str], number: str) -> str:
    """One display of several, with one tag."""
    inner = [x for b in blocks if (x := re.sub(r"\\\\\s*$", "", inner_of(b)).strip())]
    if not inner:
        return "".join(blocks[-1:])
    body = " \\\\\n".join(inner)
    wrap = len(inner) > 1 or (("\\\\" in body or "&" in body) and not re.search(r"\\begin\{(?:aligned|alignedat|split|array|cases|[pbvV]?matrix|smallmatrix)\}", body))
    return "\\[\n" + (f"\\begin{{aligned}}\n{body}\n\\end{{aligned}}" if wrap else body) + f"\n\\tag{{{number}}}\n\\]"


def attach_numbers(s: str) -> str:
    """A line with a number alone becomes the tag of the displays right before it, which become one; it goes if one has that tag already."""
    out: list[tuple[str, str]] = []
    pieces = [(kind, x) for kind, seg in split_displays(s) for x in (seg.splitlines(True) if kind == "text" else [seg])]
    for kind, x in pieces:
        m = ALONE.match(x.strip()) if kind == "text" else None
        run: list[str] = []
        if m:
            while out and (out[-1][0] == "math" or not out[-1][1].strip()):
                k, block = out.pop()
                run = [block, *run] if k == "math" else run
        if not run:
            out.append((kind, x))
        elif any(rf"\tag{{{m[1]}}}" in b or rf"\tag*{{{m[1]}}}" in b for b in run):
            out += [("math", b) for b in run]
        else:
            out.append(("math", merge_displays(run, m[1])))
    return "".join(x for _, x in out)


def bind_numbers(s: str) -> tuple[str, int]:
    """(text, moved): a number alone after a fenced display moves into it as a tag, with the blank lines after it; a display with a tag keeps its own."""
    out: list[str] = []
    moved, skip = 0, False
    for x in s.splitlines():
        if skip and not x.strip():
            continue
        skip = False
        if FENCE_NUMBER.match(x.strip()):
            end = next((k for k in range(len(out) - 1, -1, -1) if out[k].strip()), -1)
            if end >= 0 and FENCE.match(out[end]):
                begin = next((k for k in range(end - 1, -1, -1) if FENCE.match(out[k])), -1)
                if begin >= 0 and not any("\\tag{" in y for y in out[begin + 1 : end]):
                    out.insert(end, f"\\tag{{{x.strip()[1:-1].strip()}}}")
                    moved, skip = moved + 1, True
                    continue
        out.append(x)
    return "\n".join(out).strip(), moved


# Operators


def each(docs: DataFrame, rule: Callable[[str], list[dict]], schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the rows that a rule makes of each text."""
    names = [f.split()[0] for f in re.sub(r"<[^>]*>", "", schema).split(",")]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256)
                ids, rows = [], []
                for i, t in zip(p.column(0).to_pylist(), p.column(1).to_pylist()):
                    got = rule(t)
                    rows += got
                    ids += [i] * len(got)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, p.schema.field(0).type), *(pa.array([r[n] for r in rows], t) for n, t in zip(names, types))], [kept, *names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kept, whole = "doc_id", f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {schema}"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    types = [f.type for f in to_arrow_schema(StructType.fromDDL(schema))]
    return src.mapInArrow(run, whole)


def display_blocks(docs: DataFrame, **cols) -> DataFrame:
    """doc_id, position, block."""
    return each(docs, lambda s: [{"position": a, "block": s[a:b].strip()} for a, b in displays(s)], "position int, block string", **cols)


def equation_index(docs: DataFrame, fallback: bool = False, **cols) -> DataFrame:
    """doc_id, tag, label_key, display_tag, content, equation, equation_full, position."""
    make = fallback_index if fallback else tag_index
    rows = each(docs, lambda s: [{"tag": t} | e for t, e in make(s).items()], "tag string, content string, equation string, equation_full string, position int", **cols)
    return rows.select("doc_id", "tag", F.concat(F.lit("eq:"), "tag").alias("label_key"), F.concat(F.lit("("), "tag", F.lit(")")).alias("display_tag"), "content", "equation", "equation_full", "position")


def theorem_index(docs: DataFrame, **cols) -> DataFrame:
    """doc_id, ref (kind:number), display_ref, content."""
    return each(docs, lambda s: [{"ref": k, "display_ref": x["display"], "content": x["content"]} for k, x in statement_index(s).items()], "ref string, display_ref string, content string", **cols)


def references(docs: DataFrame, **cols) -> DataFrame:
    """doc_id, refs, evidence, unresolved, against the indexes of the same text; tags come before the fallback's numbers."""

    def rule(s):
        tags, more = tag_index(s), fallback_index(s)
        by_base: dict[str, list[str]] = {}
        for t in sorted((t for t in more if t not in tags), key=str.lower):
            if m := re.fullmatch(r"(\d+(?:\.\d+)*)[A-Za-z]", t):
                by_base.setdefault(m[1], []).append(t)
        refs, by, missing = body_refs(s, more | tags, by_base)
        return [{"refs": refs, "evidence": [by[t] for t in refs], "unresolved": missing}]

    return each(docs, rule, "refs array<string>, evidence array<string>, unresolved array<string>", **cols)


def expanded(docs: DataFrame, most: int = 5, **cols) -> DataFrame:
    """doc_id, text, notes: texts whose references resolve within the text itself, expanded; other texts as they are."""

    def rule(s):
        text, notes = expand(s, fallback_index(s) | tag_index(s), statement_index(s), most)
        return [{"text": text, "notes": notes}]

    return each(docs, rule, "text string, notes array<string>", **cols)


def numbered(docs: DataFrame, **cols) -> DataFrame:
    """doc_id, text with numbers attached to displays, bound text, moved."""

    def rule(s):
        bound, moved = bind_numbers(s)
        return [{"text": attach_numbers(s), "bound": bound, "moved": moved}]

    return each(docs, rule, "text string, bound string, moved int", **cols)
