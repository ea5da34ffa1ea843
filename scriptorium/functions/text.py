"""Text cleaning and quality predicates as Catalyst expressions (Column → Column). Null text counts as empty."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Marks of leaked prompts, penalties, and line patterns that results depend on.
PROMPT_MARKERS = [
    "the output must be latex", "output markdown only", "output only the content", "strict block rules", "placeholder tokens",
    "do not move placeholders", "extract all text and math", "you are doing ocr",
]
LEAK_PATTERNS = ["the output must be latex", "strict block rules", "markdown:", "you must keep every placeholder", "output only latex"]
LEAK_LINES = [
    "the output must be latex", "output only latex", "strict block rules", "the input may contain placeholder tokens",
    "you must keep every placeholder token exactly unchanged", "do not move placeholders", r"critical:\s*do not invent any new \\tag",
    r"^markdown:\s*$", r"^math rules:\s*$", r"^formatting:\s*$", r"^task:\s*$", "^hard rules", "^<<<proof>>>$", "^<<<rest>>>$",
]
PENALTIES = {
    "empty": 5000, "prompt_echo": 4500, "runaway_number_list": 4200, "line_repetition": 3800, "sub-loop": 3000, "excessive_quad": 2000,
    "excessive_newlines": 1500, "char_repetition": 1500, "unbalanced_braces": 900,
}
LAYOUT = r"\b(text|equation|interline_equation|sub_title|title|figure|table)\s*\[\[\d+,\s*\d+,\s*\d+,\s*\d+\]\]"
UNICODE_MATH = "[≤≥≠≈∈∉⊂⊆⊃⊇→⇒↦×·∞∇ℝℕℤℚℂ]"
#: Characters of Unicode's White_Space; trimming by a list is linear, a pattern for a trailing run isn't.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: A page mark on a line of its own; group 1 is its number.
PAGE = r"(?m)^\s*<!--\s*PAGE\s+(\d+)\s*-->\s*$"
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once; elsewhere, and inside lambdas above all, each mention of an expression evaluates it again."""
    return F.element_at(F.transform(F.array(c), f), 1)


def text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def squeeze(c: Column) -> Column:
    # Most lines have single spaces alone, which needn't be replaced by themselves.
    return let(c, lambda x: strip(F.when(F.contains(x, F.lit("  ")) | (F.octet_length(x) != F.length(x)) | x.rlike(r"[\t-\r]"), F.regexp_replace(x, r"(?U)\s+", " ")).otherwise(x)))


def any_of(c: Column, patterns: list[str], flags: str = "(?i)") -> Column:
    return c.rlike(flags + "(?:" + "|".join(patterns) + ")")


def lines(c) -> Column:
    """Lines without their ends; no empty item after a final line end."""
    parts = F.split(text(c), LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def join(a: Column) -> Column:
    return F.array_join(a, "\n")


def filled(a: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(a, strip), lambda x: x != "")


def keep_lines(c, test) -> Column:
    return strip(join(F.filter(lines(c), test)))


# Cleaning


def strip_code_fences(c, language: str = "md|markdown") -> Column:
    s = F.regexp_replace(strip(text(c)), rf"(?i)^\s*```(?:{language})?\s*", "")
    return strip(F.regexp_replace(s, r"\s*```\s*\z", ""))


def strip_layout_boxes(c) -> Column:
    cut = F.transform(lines(c), lambda x: rstrip(F.regexp_replace(x, r"^\s*\w+\s*\[\[\d+,\s*\d+,\s*\d+,\s*\d+\]\]\s*", "")))
    return strip(join(F.filter(cut, lambda x: x != "")))


def valid_patterns(patterns: list) -> list[str]:
    """Those of a list that are patterns; anything else is passed over."""
    out = []
    for p in patterns if isinstance(patterns, list) else []:
        if isinstance(p, str) and p.strip():
            try:
                re.compile(p)
            except re.error:
                continue
            out.append(p)
    return out


#: Fixed value: the line that the paper route drops.
DO_NOT_CHANGE = [r"\s*do\s+not\s+change\s+the\s+text(\s+in\s+the\s+image)?\s*\.?\s*$"]


def strip_leading_boilerplate(c, patterns: list[str], most: int = 6) -> Column:
    """struct(text, removed): leading lines that start with a pattern go, up to a number; blank ones between them are passed over."""
    all_, blank = lines(c), lambda x: strip(x) == ""
    own = F.filter(F.transform(all_, lambda x, k: F.struct(k.alias("k"), x.alias("x"))), lambda p: ~blank(p["x"]))
    hits = F.transform(F.slice(own, 1, most), lambda p: any_of(p["x"], [f"^(?:{q})" for q in valid_patterns(patterns)] or [r"(?!)"]))
    stop = F.array_position(hits, False).cast("int")
    n = F.when(stop > 0, stop - 1).otherwise(F.size(hits))
    start = F.when(n < F.size(own), F.try_element_at(own, n + 1)["k"]).otherwise(F.size(all_))
    return F.struct(strip(join(F.slice(all_, start + 1, F.greatest(F.size(all_) - start, F.lit(0))))).alias("text"), n.alias("removed"))


_NUM = r"(\d+(?:\.\d+)+)"
_HEADERS = [rf"(?i)^(\s*)\*\*Exercise\s+{_NUM}\*\*(.*)$", rf"(?i)^(\s*)#{{1,6}}\s*Exercise\s+{_NUM}\s*(.*)$", rf"^(\s*)#{{1,6}}\s*{_NUM}\s*[):.]?\s*(.*)$", rf"(?i)^(\s*)Exercise\s+{_NUM}\s*(.*)$", rf"^(\s*)(\d+(?:\.\d+)+)\s*[):.]?\s*(.*)$"]
_BOLD = rf"^(\s*)\*\*{_NUM}(?:\s+([^*]*?))?\*\*(.*)$"


def exercise_header(line: Column, strict: bool = False) -> Column:
    """Canonical ``**Exercise x.y** tail`` of one line. strict leaves a bare decimal alone."""

    def header(line):
        part = lambda p, k: F.regexp_extract(line, p, k)
        head = lambda p, tail: F.concat(part(p, 1), F.lit("**Exercise "), part(p, 2), F.lit("**"), F.when(tail != "", F.concat(F.lit(" "), tail)).otherwise(""))
        plain = [(p, head(p, strip(part(p, 3)))) for p in _HEADERS]
        bold = (_BOLD, head(_BOLD, strip(F.concat_ws(" ", F.filter(F.array(strip(part(_BOLD, 3)), strip(part(_BOLD, 4))), lambda x: x != "")))))
        rules = [plain[0], bold, *plain[1 : 4 if strict else 5]]
        # Each of them has a number with a point.
        return F.when(F.contains(line, F.lit(".")) & line.rlike(r"\d\.\d"), F.coalesce(*(F.when(line.rlike(p), v) for p, v in rules), line)).otherwise(line)

    return let(rstrip(line), header)


def normalize_exercise_headers(c, strict: bool = False) -> Column:
    return join(F.transform(lines(c), lambda x: exercise_header(x, strict)))


_SOLUTION, _SUBPART = r"(?i)\b(?:\*\*|__)?solution(?:\*\*|__)?\s*[:.]", r"(?i)\(\s*[a-z]\s*\)"


def split_solution_boundaries(c) -> Column:
    """A line with a solution mark and a subpart mark breaks before the later one."""

    def cut(x):
        s = rstrip(x)
        a, b = F.regexp_instr(s, F.lit(_SOLUTION)), F.regexp_instr(s, F.lit(_SUBPART))
        at = F.greatest(a, b)
        halves = F.filter(F.array(rstrip(F.substring(s, 1, at - 1)), F.regexp_replace(F.substring(s, at, F.length(s)), r"(?U)^\s+", "")), lambda y: y != "")
        return F.when((a > 0) & (b > 0) & (a != b), halves).otherwise(F.array(x))

    return strip(join(F.flatten(F.transform(lines(c), cut))))


_HEADING = r"(?i)^\s*(?:\*\*|__)?solution(?:\*\*|__)?\s*[:.]?\s*(.*)$"


def normalize_solution_headings(c) -> Column:
    def cut(x):
        s = strip(x)
        tail = strip(F.regexp_extract(s, _HEADING, 1))
        return F.when(s.rlike(_HEADING), F.filter(F.array(F.lit("Solution."), tail), lambda y: y != "")).otherwise(F.array(x))

    return strip(join(F.flatten(F.transform(lines(c), cut))))


def normalize_blank(c) -> Column:
    return F.regexp_replace(F.replace(text(c), F.lit("\u00a0"), F.lit(" ")), "\n{4,}", "\n\n\n")


def drop_leak_lines(c) -> Column:
    return keep_lines(c, lambda x: ~any_of(strip(x), LEAK_LINES))


def drop_runaway_lines(c, most: int = 80) -> Column:
    # The exact count means the same as "or more" and can't exhaust the stack.
    return keep_lines(c, lambda x: ~x.rlike(rf"(?:\b\d+\.\s*){{{most}}}"))


def squash_repeats(c, run: int = 2, least: int = 24) -> Column:
    """At most ``run`` lines of consecutive equal ones, if ``least`` characters long."""

    def keyed(x):
        key = let(F.lower(squeeze(x)), lambda k: F.when(F.length(k) >= least, k))  # lower case at most doubles a line's length
        return F.struct(x.alias("line"), F.when(F.length(x) * 2 >= least, key).alias("key"))

    def kept(rows):
        # A line goes if the run of lines before it have its key.
        again = lambda x, k: (k >= run) & reduce(and_, (F.try_element_at(rows, k - j)["key"] == x["key"] for j in range(run)), x["key"].isNotNull())
        return F.transform(F.filter(rows, lambda x, k: F.when(k < run, True).otherwise(~F.coalesce(again(x, k), F.lit(False)))), lambda x: x["line"])

    return strip(join(let(F.transform(lines(c), keyed), kept)))


def drop_figures(c) -> Column:
    s = join(F.filter(lines(c), lambda x: ~x.rlike(r"(?i)^\s*\[\s*figure(?:\s*:[^\]]*)?\s*\]\s*$")))
    return strip(F.regexp_replace(s, "\n{3,}", "\n\n"))


def sanitize(c) -> Column:
    s = F.regexp_replace(text(c), "\r\n?", "\n")
    return strip(drop_figures(squash_repeats(drop_runaway_lines(drop_leak_lines(s)))))


def strip_outer_document(c) -> Column:
    s = F.regexp_replace(text(c), r"(?s)\\documentclass.*?\\begin\{document\}", "")
    return strip(F.regexp_replace(s, r"\\end\{document\}\s*\z", ""))


def strip_outer_env(c, env: str) -> Column:
    p = rf"(?s)^\s*\\begin\{{{env}\}}\s*(.*?)\s*\\end\{{{env}\}}\s*\z"
    return F.when(text(c).rlike(p), F.regexp_extract(text(c), p, 1)).otherwise(text(c))


def display_math(c) -> Column:
    return F.regexp_replace(text(c), r"(?s)\$\$\s*(.*?)\s*\$\$", "\\\\\\[\n$1\n\\\\\\]")


def compact(c, most: int = 320) -> Column:
    t = squeeze(text(c))
    return F.when(F.length(t) <= most, t).otherwise(F.concat(rstrip(F.substring(t, 1, most - 1)), F.lit("…")))


def unescape_keep_tex(c) -> Column:
    s = F.replace(text(c), F.lit('\\"'), F.lit('"'))
    for mark, plain in (("n", "\n"), ("t", "\t"), ("r", "\r")):
        s = F.regexp_replace(s, rf"\\{mark}(?![A-Za-z])", plain)
    return s


def for_compare(c) -> Column:
    s = F.regexp_replace(F.regexp_replace(text(c), "\r\n?", "\n"), r"\\tag\{[^}]*\}", "")
    return strip(join(F.transform(lines(s), squeeze)))


def truncate_middle(c, most: int = 12000) -> Column:
    s = strip(text(c))
    return F.when(F.length(s) <= most, s).otherwise(F.concat(F.substring(s, 1, most // 2), F.lit("\n...\n"), F.right(s, F.lit(most // 2))))


def problem_text(c) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(c)), r"\\[a-z]+", " "), r"\s+", " ")


def probe_line(c) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text(c), r"\*\*|__|`", ""), r"^\s*>+\s*", ""))


def block_key(c) -> Column:
    return strip(join(F.transform(lines(c), rstrip)))


def escape_attr(c) -> Column:
    s = F.replace(text(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(s, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def unescape_attr(c: Column) -> Column:
    s = F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), F.substring(c, 2, F.length(c) - 2)).otherwise(c)
    return F.replace(F.replace(F.replace(s, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))


def tag_token(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(strip(c), r"^[()\[\]]+|[()\[\]]+$", ""), r"\s+", "")


def star_environments(c) -> Column:
    s = text(c)
    for env in ("equation", "align", "gather", "multline", "eqnarray"):
        s = F.regexp_replace(s, rf"\\(begin|end)\{{{env}\}}", rf"\\$1{{{env}*}}")
    return s


# Predicates and scores


def is_layout(c) -> Column:
    s = strip(text(c))
    return (s == "") | F.substring(s, 1, 1000).rlike(LAYOUT)


def has_prompt_marks(c) -> Column:
    return let(F.lower(text(c)), lambda t: reduce(or_, (F.contains(t, F.lit(m)) for m in PROMPT_MARKERS)))


def has_prompt_leak(c) -> Column:
    return any_of(text(c), LEAK_PATTERNS)


def has_runaway_list(c, most: int = 120) -> Column:
    return text(c).rlike(rf"(?:\b\d+\.\s*){{{most}}}")


def has_heavy_repetition(c) -> Column:
    """Twelve lines or more, and a line of 24 characters that stands six times or is a quarter of them."""
    # Longest run of equal items of the sorted array.
    start = F.struct(F.lit(None).cast("string").alias("k"), F.lit(0).alias("n"), F.lit(0).alias("m"))

    def step(s, x):
        n = F.when(x == s["k"], s["n"] + 1).otherwise(1)
        return F.struct(x.alias("k"), n.alias("n"), F.greatest(s["m"], n).alias("m"))

    def most(own):  # lower case at most doubles a line's length
        key = F.transform(F.filter(own, lambda x: F.length(x) >= 12), lambda x: F.lower(squeeze(x)))
        return F.aggregate(F.array_sort(F.filter(key, lambda x: F.length(x) >= 24)), start, step, lambda s: s["m"])

    heavy = lambda own: F.when(F.size(own) >= 12, let(most(own), lambda m: (m >= 6) | ((m > 0) & (m * 4 >= F.size(own))))).otherwise(False)
    return let(lines(c), lambda all_: F.when(F.size(all_) >= 12, let(filled(all_), heavy)).otherwise(False))


def penalty(reason: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in PENALTIES.items() for x in kv))
    return F.when(F.coalesce(reason, F.lit("")) == "", 0).otherwise(F.coalesce(F.try_element_at(table, reason), F.lit(1000)))


def score(c, bad: Column, reason: Column, layout: Column, heavy: Column | None = None) -> Column:
    """heavy: whether the text repeats itself, if that is known already."""
    s = strip(text(c))
    size = let(F.length(s), lambda n: F.when(n < 20, -1000).when(n < 80, -300).when(n <= 14000, F.least(F.lit(1800), F.floor(n / 6))).otherwise(-F.least(F.lit(2200), F.floor((n - 14000) / 10))))
    repeats = has_heavy_repetition(s) if heavy is None else heavy
    loss = F.when(layout, 80).otherwise(0) + F.when(has_prompt_marks(s), 3000).otherwise(0) + F.when(has_runaway_list(s), 3000).otherwise(0) + F.when(repeats, 2200).otherwise(0)
    return (F.when(bad, -penalty(reason)).otherwise(2000) + size - loss).cast("int")


def first_bad_reason(c) -> Column:
    """The first check that fails, or null."""

    def first(s):
        opens, closes = F.regexp_count(s, F.lit(r"\{")), F.regexp_count(s, F.lit(r"\}"))
        return (
            F.when(s == "", "empty").when(F.contains(F.lower(s), F.lit("sub-sub-sub")), "sub-loop").when(has_prompt_marks(s), "prompt_echo")
            .when(has_runaway_list(s), "runaway_number_list").when(has_heavy_repetition(s), "line_repetition").when(F.regexp_count(s, F.lit(r"\\quad")) > 50, "excessive_quad")
            .when(s.rlike("\n{9}"), "excessive_newlines").when(s.rlike(r"([^\s.\-_=])\1{19}"), "char_repetition").when(F.abs(opens - closes) > 8, "unbalanced_braces")
        )

    return let(strip(text(c)), first)


def interleaved_columns(c) -> Column:
    def test(own):
        n, total = F.greatest(F.size(own), F.lit(1)), F.aggregate(own, F.lit(0), lambda a, x: a + x)  # blank texts have no line to share by
        share = lambda k: F.size(F.filter(own, lambda x: x <= k)) / n
        return (n >= 40) & (((share(35) >= 0.55) & (total / n <= 55)) | ((share(18) >= 0.30) & (total / n <= 65)))

    return (F.length(strip(text(c))) >= 400) & let(F.transform(filled(lines(c)), F.length), test)


def unbalanced_display(c) -> Column:
    return F.when(F.contains(text(c), F.lit("$$")), F.size(F.filter(lines(c), lambda x: x.rlike(r"^\s*\$\$\s*$"))) % 2).otherwise(0)


@F.arrow_udf(IntegerType())
def _bracket_errors(marks: pa.Array) -> pa.Array:
    pair, out = {")": "(", "}": "{", "]": "["}, []
    for s in marks.to_pylist():
        stack, bad = [], 0
        for x in s or "":
            if x not in pair:
                stack.append(x)
            elif not stack or stack.pop() != pair[x]:
                bad += 1
        out.append(bad + len(stack))
    return pa.array(out, pa.int32())


def bracket_errors(c) -> Column:
    """Brackets that don't match, by a stack; linear, over the brackets alone."""
    return _bracket_errors(F.regexp_replace(text(c), r"[^(){}\[\]]+", ""))


def short_title(c) -> Column:
    s = strip(text(c))
    return (s != "") & (F.length(s) <= 90) & ~s.endswith(".") & s.rlike("[A-Za-z]") & ~s.rlike(r"(?i)\b(is|are|was|were|have|has|that|which|whenever)\b")


def not_english(c) -> Column:
    s = strip(text(c))
    return (s == "") | s.rlike("[\u4e00-\u9fff]")


def english_ok(c, least: int = 6, share: float = 0.6) -> Column:
    s = strip(text(c))
    # Counted by what stays when all else goes, and words without going back, so that no array of a text's letters is made.
    ascii_, every = (F.length(F.regexp_replace(s, p, "")) for p in ("[^A-Za-z]+", r"\P{L}+"))
    words = s.rlike(rf"^[^A-Za-z]*+(?:[A-Za-z]++(?:'[A-Za-z]++)?+[^A-Za-z]*+){{{least}}}")
    ratio = F.when(F.octet_length(s) == F.length(s), F.lit(1.0)).otherwise(ascii_ / F.greatest(every, F.lit(1)))  # any word is a letter
    return ~not_english(c) & words & (ratio >= share)


def math_sane(c) -> Column:
    t = strip(text(c))
    count = lambda x: F.regexp_count(t, F.lit(x))
    items = F.transform(F.regexp_extract_all(t, F.lit(r"(?m)^\s*\d+\.\s*(.+)$"), F.lit(1)), strip)
    broken = t.rlike(r"(?m)^\s*\d+\.\s*(?:[-,:;]|\\(?:le|ge|ne|in|to|times|cdot|subset|subseteq)\b)")
    return (t != "") & (count(r"\\\(") == count(r"\\\)")) & (count(r"\\\[") == count(r"\\\]")) & ~broken & ~t.rlike(UNICODE_MATH) & F.forall(items, lambda x: (F.length(x) >= 6) & x.rlike("[A-Za-z]"))


def task_sentence(c) -> Column:
    lead = F.regexp_replace(strip(text(c)), r"(?i)^(Equivalently|Also|Then|Next|Moreover|Furthermore|Hence|Thus|Finally)\s*,?\s+", "")
    return lead.rlike(r"(?i)^(Prove|Show|Find|Compute|Derive|Determine|Verify|Establish|Evaluate|Minimize|Maximize)\b")


def tex_complete(c) -> Column:
    s = text(c)
    return (F.contains(F.substring(s, 1, 65536), F.lit("\\begin{document}")) | F.contains(F.right(s, F.lit(65536)), F.lit("\\begin{document}"))) & s.rlike(r"\\end\{document\}\s*\z")


def pages_complete(c, pages: Column) -> Column:
    """Whether the largest page mark reaches pages; any text that isn't empty does if it has no mark or pages is null."""
    marks = F.array_max(F.transform(F.regexp_extract_all(text(c), F.lit(PAGE), F.lit(1)), lambda x: x.cast("double")))  # of any number of digits
    return (text(c) != "") & (marks.isNull() | pages.isNull() | (marks >= pages))
