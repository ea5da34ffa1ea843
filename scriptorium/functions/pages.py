"""Rules on pages, labels and rendered blocks as Catalyst expressions (Column → Column). Null text counts as empty."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .records import statement_kind, statement_refs
from .text import any_of, compact, escape_attr, filled, for_compare, has_prompt_leak, is_layout, join, let, lines, probe_line, strip, strip_code_fences, strip_outer_document, text, unbalanced_display

#: Running headers and what follows a header glued into a line, echoes, and commands that bound blocks.
RUNNING_HEADERS = [
    r"^\s*#*\s*Exercises\s*$", r"^\s*#*\s*Chapter\s+\d+\s*$", r"^\s*#*\s*\d+\s+Convex sets\s*$", r"^\s*#*\s*\d+\s+Convex functions\s*$",
    r"^\s*#*\s*\d+\s+Duality\s*$", r"^\s*#*\s*Generalized inequalities\s*$",
]
GLUED_HEADERS = ["Exercises", r"\d+\s+Convex sets", r"\d+\s+Duality"]
HEADER_WORDS = ["exercises", "chapter", "convex sets", "convex functions", "duality", "generalized inequalities"]  # each of those has one
ECHOES = ["ocr to markdown", "output markdown only", "output only the content", "extract all text and math"]
HARD_STARTS = [r"\section", r"\subsection", r"\subsubsection", r"\chapter", r"\paragraph", r"\clearpage", r"\newpage", "% ===== Page"]
MATH_ENVIRONMENTS = r"\\begin\{(?:array|cases|aligned|alignedat|split|matrix|pmatrix|bmatrix|vmatrix|Vmatrix|smallmatrix)\}"
MATH_WORDS = r"\\(mathbf|mathbb|alpha|beta|gamma|delta|sum|int|frac|prod|sqrt|left|right|quad|cdot|leq|geq|neq|times|to|rightarrow|leftarrow)\b"
TAIL_NUMBER = r"(?s)^(.*?)(?:(?:\s*(?:\\qquad|\\quad|\\hfill)\s*)+|\s+)\((\d+(?:\.\d+)*(?:[A-Za-z])?)\)\s*$"
TITLE = r"(?i)\bExercise\s+(\d+(?:\.\d+)+)\b"
STATEMENT = r"(?i)\b(Theorem|Thm\.?|Lemma|Lem\.?|Algorithm|Alg\.?)\s+(\d+(?:\.\d+)*)\b"
ORIGIN_ENVIRONMENTS = "defn|thm|lem|prop|cor|alg"


def running_headers(c) -> Column:
    """struct(text, removed): lines that are a running header go, headers glued into a line become a blank; those count as one."""

    def result(all_, rest):
        kept = join(rest)
        cut = kept
        for p in GLUED_HEADERS:
            cut = F.regexp_replace(cut, rf"(?i)(?<=[A-Za-z0-9\.\)\]])\s*{p}\s+(?=(?:\d+\.\d+\b|[A-Z]\w))", " ")
        return let(cut, lambda t: F.struct(strip(t).alias("text"), (F.size(all_) - F.size(rest) + (t != kept).cast("int")).alias("removed")))

    found = let(F.lower(text(c)), lambda t: reduce(or_, (F.contains(t, F.lit(w)) for w in HEADER_WORDS)))
    none = F.struct(strip(join(lines(c))).alias("text"), F.lit(0).alias("removed"))
    return F.when(~found, none).otherwise(let(lines(c), lambda all_: let(F.filter(all_, lambda x: let(strip(x), lambda y: (y == "") | ~any_of(y, RUNNING_HEADERS))), lambda rest: result(all_, rest))))


def tidy_page(c) -> Column:
    """No-break spaces become spaces, and four or more line ends three."""
    return strip(F.regexp_replace(F.translate(text(c), "\xa0", " "), r"\n{4,}", "\n\n\n"))


def plain_symbols(c) -> Column:
    return F.translate(F.replace(text(c), F.lit("§"), F.lit(r"\S ")), "\xa0", " ")


def caption(label, rest) -> Column:
    s = F.regexp_replace(strip(F.concat(text(label), F.lit(" "), text(rest))), r"\s+([:;,\.])", "$1")
    return strip(F.regexp_replace(s, r"\s{2,}", " "))


def without_commands(c) -> Column:
    """Bold and emphasised words stay, their commands and the delimiters of formulas go."""
    def plain(s):
        for name in ("textbf", "emph", "mathbf"):
            s = F.regexp_replace(s, rf"\\{name}\{{([^}}]*)\}}", "$1")
        return F.regexp_replace(s, r"\\[()\[\]]", "")

    return let(text(c), lambda s: strip(F.when(F.contains(s, F.lit("\\")), plain(s)).otherwise(s)))


def looks_bad(c) -> Column:
    s = strip(text(c))
    head = F.lower(F.substring(s, 1, 800))
    echo = F.lit(False)
    for e in ECHOES:
        echo = echo | head.startswith(e)
    return (s == "") | F.contains(head, F.lit("sub-sub-sub")) | ((F.length(s) < 120) & echo)


def page_score(c, brackets: Column, truncated: Column, cut_off: Column) -> Column:
    """Length less penalties; brackets are the mismatches of the first 8000 characters."""
    s = strip(text(c))
    off = lambda test, n: F.when(test, F.lit(float(n))).otherwise(0.0)
    own = F.length(s) - off(looks_bad(s), 5000) - off(is_layout(s), 2000) - 1500.0 * unbalanced_display(s) - 40.0 * brackets - off(truncated, 2500) - off(cut_off, 2000)
    return F.when(s == "", -1e9).otherwise(own.cast("double"))


PHRASE = (20, 80, 5)  # a phrase's least and most characters, and how often it stands in a row


@lru_cache(maxsize=None)
def _blocks(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, start, length) of all blocks to compare in n characters, by end."""
    pairs = [(np.arange(0, n - 3 * p + 1, 2 * p), p) for p in range(PHRASE[0], PHRASE[1] + 1)]
    start, length = np.concatenate([k for k, _ in pairs]), np.concatenate([np.full(len(k), p) for k, p in pairs])
    order = np.argsort(start + 3 * length, kind="stable")
    return (start + 3 * length)[order], start[order], length[order]


def phrase_repeats(s: str) -> bool:
    """Whether a phrase stands five times in a row within a line: what (.{20,80})\\1{4,} finds by trying all lengths at all places.

    A phrase of p characters five times is 4 p places in a row that equal the one p later; these hold a whole block of 2 p
    from a multiple of 2 p, so one look at each such block is enough. Longer lines go in pieces that overlap.
    """
    least, _, times = PHRASE
    size = 1 << 14
    for line in re.split("[\n\r\x85\u2028\u2029]", s):
        for begin in range(0, max(len(line) - 1000, 1), size - 1000):
            part = line[begin : begin + size]
            if len(part) < least * times:
                continue
            a = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            end, at, p = _blocks(min(size, 1 << len(part).bit_length()))
            n = np.searchsorted(end, len(part), "right")
            at, p = at[:n], p[:n]
            for over in (1, 2, 3, 5):  # a few places of each block before all of it
                k = at + 2 * p // over - 1
                same = a[k] == a[k + p]
                at, p = at[same], p[same]
            for k, q in zip(at.tolist(), p.tolist()):
                if part[k : k + 2 * q] == part[k + q : k + 3 * q]:
                    lo, hi = k, k + 2 * q
                    while lo and hi - lo < (times - 1) * q and part[lo - 1] == part[lo - 1 + q]:
                        lo -= 1
                    while hi + q < len(part) and hi - lo < (times - 1) * q and part[hi] == part[hi + q]:
                        hi += 1
                    if hi - lo >= (times - 1) * q:
                        return True
    return False


@F.arrow_udf(BooleanType())
def _phrase_repeats(a: pa.Array) -> pa.Array:
    return pa.array([phrase_repeats(re.sub("[ \t\n\x0b\f\r]+", " ", x.as_py())) for x in a], pa.bool_())


def pathological(c) -> Column:
    """One line eight times among twenty or more, a run of eighty numbers, or a phrase five times in a row."""
    t = strip(text(c))
    eighth = lambda own: F.exists(F.sequence(F.lit(1), F.size(own) - 7), lambda k: F.element_at(own, k) == F.element_at(own, k + 7))
    sorted_ = lambda all_: let(F.array_sort(filled(all_)), lambda own: F.when(F.size(own) >= 20, eighth(own)).otherwise(False))
    many = let(lines(t), lambda all_: F.when(F.size(all_) >= 20, sorted_(all_)).otherwise(False))
    # The exact count means the same as "or more" and can't exhaust the stack.
    return many | t.rlike(r"(?:\b\d+\.\s*){80}") | _phrase_repeats(t)


def reject_reason(c) -> Column:
    """Why a model's answer isn't taken: leaked prompt, repetition, or null."""
    return F.when(has_prompt_leak(c), "prompt_leak").when(pathological(c), "repetition")


def math_block(c) -> Column:
    s = text(c)
    return s.rlike(r"\\tag\*?\{") | s.rlike(MATH_ENVIRONMENTS) | F.contains(s, F.lit("\\text{")) | (F.contains(s, F.lit("&")) & F.contains(s, F.lit("\\\\"))) | s.rlike(MATH_WORDS) | (s.rlike("[=<>]") & s.rlike(r"\\[A-Za-z]+"))


def needs_aligned(c) -> Column:
    s = text(c)
    return ~s.rlike(r"\\begin\{(?:aligned|alignedat|split|array|cases|matrix|pmatrix|bmatrix|vmatrix|Vmatrix|smallmatrix)\}") & (F.contains(s, F.lit("\\\\")) | F.contains(s, F.lit("&")))


def hard_boundary(line) -> Column:
    s, found = F.ltrim(text(line), F.lit(" \t\n\x0b\x0c\r")), F.lit(False)
    for start in HARD_STARTS:
        found = found | s.startswith(start)
    return found


def begins_structure(line) -> Column:
    return hard_boundary(line) | text(line).rlike(r"^\s*(?:\\begin\{|%</?BLOCK\b)")


def bounds_markdown(line) -> Column:
    """Exercise starts, section lines, headings and heading marks."""
    s = probe_line(line)
    return (s != "") & (s.rlike(r"(?i)^(?:Exercise\s+)?\d+(?:\.\d+)+\s*.*$") | s.rlike(r"(?i)^\s*(SECTION|CHAPTER)\s+(\d+)\s*$") | s.startswith("#") | s.isin("<!-- HEADING_START -->", "<!-- HEADING_END -->"))


def tail_number(c) -> Column:
    """struct(body, number) of a formula with a number in brackets at its end; number null without one."""
    s = strip(text(c))
    return F.struct(F.when(s.rlike(TAIL_NUMBER), F.regexp_replace(F.regexp_extract(s, TAIL_NUMBER, 1), r"\s+\z", "")).otherwise(s).alias("body"), F.when(s.rlike(TAIL_NUMBER), F.regexp_extract(s, TAIL_NUMBER, 2)).alias("number"))


def split_option(c) -> Column:
    """Items of a comma-separated option, lower-cased."""
    return F.filter(F.transform(F.split(text(c), ","), lambda x: F.lower(strip(x))), lambda x: x != "")


def json_filled(c) -> Column:
    """Whether a text is a JSON array or object that isn't empty."""
    s = text(c)
    return F.coalesce(F.greatest(F.json_array_length(s), F.size(F.json_object_keys(s))) > 0, F.lit(False))


@F.arrow_udf(BooleanType())
def _close(a: pa.Array, b: pa.Array, least: pa.Array) -> pa.Array:
    return pa.array([x == y or SequenceMatcher(None, x, y).ratio() >= t for x, y, t in zip(a.to_pylist(), b.to_pylist(), least.to_pylist())], pa.bool_())


def similar_enough(a, b, least: float = 0.995) -> Column:
    """Equal after normalisation, or with that share of matching blocks."""
    return _close(for_compare(a), for_compare(b), F.lit(least))


# Labels and rendering


def first_line(c) -> Column:
    """The first line that isn't blank, stripped."""
    return F.coalesce(F.try_element_at(filled(lines(c)), F.lit(1)), F.lit(""))


def first_and_rest(c) -> Column:
    """struct(first, rest) about the first line that isn't blank."""
    all_ = lines(c)
    at = F.array_position(F.transform(all_, lambda x: strip(x) != ""), True).cast("int")
    return F.when(at > 0, F.struct(strip(F.try_element_at(all_, at)).alias("first"), strip(join(F.slice(all_, at + 1, F.size(all_)))).alias("rest"))).otherwise(F.struct(F.lit("").alias("first"), F.lit("").alias("rest")))


def block_label(env: Column, body, statements: bool = False) -> Column:
    """Proof; exercise (or statement) and number from the first eight lines; else the first line, cut at 120."""
    p = STATEMENT if statements else TITLE

    def named(head):
        number = F.regexp_extract(head, p, 2 if statements else 1)
        return F.concat(F.initcap(statement_kind(F.regexp_extract(head, p, 1))) if statements else F.lit("Exercise"), F.lit(" "), number)

    cut = lambda line: F.when(line == "", "UNKNOWN").when(F.length(line) > 120, F.concat(F.substring(line, 1, 120), F.lit("..."))).otherwise(line)
    short = let(without_commands(first_line(body)), cut)
    label = let(without_commands(join(F.slice(lines(body), 1, 8))), lambda head: F.when(head.rlike(p), named(head)).otherwise(short))
    return F.when(env == "proof", "Proof").otherwise(label)


def block_open(kind: Column, label, exercise=None, part=None, refs=None) -> Column:
    """The sentinel that opens a block; empty attributes are left out."""
    more = [F.when(text(v) != "", F.concat(F.lit(f'{name}="'), escape_attr(v), F.lit('"'))) for name, v in (("exercise", exercise), ("part", part), ("refs", refs)) if v is not None]
    return F.concat(F.lit("%<BLOCK "), F.concat_ws(" ", F.concat(F.lit("type="), kind), F.concat(F.lit('label="'), escape_attr(label), F.lit('"')), *more), F.lit(">"))


def subpart_block(kind: Column, exercise, part, body) -> Column:
    """A subpart between sentinels, with the statements it refers to."""
    label = F.concat(F.when(text(exercise) != "", F.concat(F.lit("Exercise "), text(exercise))).otherwise(""), F.lit("("), text(part), F.lit(")"))
    own = strip(text(body))
    return strip(F.concat_ws("\n", block_open(kind, label, exercise, part, F.array_join(statement_refs(own), ";")), own, F.lit("%</BLOCK>")))


def environment(env: Column, body, lead="") -> Column:
    """The body in an environment, after a lead line."""
    own = F.filter(F.array(strip(text(F.lit(lead) if isinstance(lead, str) else lead)), strip(text(body))), lambda x: x != "")
    return F.concat_ws("\n", F.concat(F.lit("\\begin{"), env, F.lit("}")), F.array_join(F.when(F.size(own) > 0, own), "\n"), F.concat(F.lit("\\end{"), env, F.lit("}")))


def tex_document(preamble: str, chunks: Column, end: str = "\n\\end{document}\n") -> Column:
    """A whole document of the chunks that aren't blank."""
    return F.concat(F.lit(preamble), F.regexp_replace(F.array_join(F.filter(chunks, lambda x: strip(text(x)) != ""), "\n\n"), r"\s+\z", ""), F.lit("\n" + end))


def document_body(c) -> Column:
    """What stands between the first begin and the last end of the document; without both, all."""
    p = r"(?s)\\begin\{document\}(.*)\\end\{document\}"
    return F.when(text(c).rlike(p), F.regexp_extract(text(c), p, 1)).otherwise(text(c))


def numbered_heading(number, title) -> Column:
    """A section command by the number's depth."""
    depth, full = F.size(F.split(text(number), r"\.")), strip(F.concat(text(number), F.lit(". "), text(title)))
    return F.concat(F.when(depth <= 1, r"\section{").when(depth == 2, r"\subsection{").when(depth == 3, r"\subsubsection{").otherwise(r"\paragraph{"), full, F.lit("}"))


def heading_text(c) -> Column:
    """A heading as plain lines, without its marks if it is a single line."""
    own = filled(lines(c))
    return F.when(F.size(own) == 1, F.regexp_replace(F.try_element_at(own, F.lit(1)), r"^#{1,6}\s+(.+?)\s*$", "$1")).otherwise(join(own))


def split_answer(c) -> Column:
    """struct(proof, rest) of an answer with both marks; empty texts without them."""
    t, p = strip_outer_document(strip_code_fences(c)), r"(?s)<<<PROOF_MD>>>\s*(.*?)\s*<<<REST>>>\s*(.*)\s*\z"
    return F.struct(strip(F.regexp_extract(t, p, 1)).alias("proof"), strip(F.regexp_extract(t, p, 2)).alias("rest"))


def origin_environments(c) -> Column:
    """Statement environments become one."""
    s = F.regexp_replace(text(c), rf"\\begin\{{(?:{ORIGIN_ENVIRONMENTS})\}}(?:\[[^\]]*\])?", r"\\begin{origintext}")
    return F.regexp_replace(s, rf"\\end\{{(?:{ORIGIN_ENVIRONMENTS})\}}", r"\\end{origintext}")


def label_statement(c) -> Column:
    """kind:number of the statement that a label names, empty without one."""
    s = text(c)
    return F.when(s.rlike(STATEMENT), F.concat(statement_kind(F.regexp_extract(s, STATEMENT, 1)), F.lit(":"), F.regexp_extract(s, STATEMENT, 2))).otherwise("")


def statement_key(ref) -> Column:
    """The label key of kind:number."""
    t, p = strip(text(ref)), r"(?i)^(theorem|lemma|algorithm):(\d+(?:\.\d+)*)$"
    short = F.when(F.lower(t).startswith("lemma"), "lem:").when(F.lower(t).startswith("algorithm"), "alg:").otherwise("thm:")
    return F.when(t.rlike(p), F.concat(short, F.regexp_extract(t, p, 2))).when(t == "", "").otherwise(F.concat(F.lit("thm:"), t))


def payload(record: Column, targets: Column) -> Column:
    """The enrichment input: the first target of each tag, with contents cut at 320 characters."""
    first = F.filter(targets, lambda x, k: (k == 0) | ~F.exists(F.slice(targets, 1, F.greatest(k, F.lit(1))), lambda y: y["tag"] == x["tag"]))
    eq = F.transform(first, lambda x: F.struct(x["tag"].alias("tag"), x["display_tag"].alias("display_tag"), x["equation_content"].alias("equation_content")))
    return F.struct(record["source_idx"].alias("source_idx"), record["problem"].alias("original_problem"), eq.alias("equations"), F.transform(first, lambda x: F.struct(x["tag"].alias("tag"), compact(x["content"]).alias("content"))).alias("contexts"))
