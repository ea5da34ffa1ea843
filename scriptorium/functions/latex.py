"""LaTeX healing. Each step is a plain function on one text; heal() fuses them in one vectorised UDF."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from .text import strip, text

_INNER = ("aligned", "align", "cases", "matrix", "pmatrix", "bmatrix", "vmatrix", "array", "gathered", "split", "smallmatrix")
_OUTER = ("equation", "align", "gather", "multline", "eqnarray")
_TOKEN = re.compile(r"\\\\|\\\[|\\\]|\\\(|\\\)")
_DISPLAY = re.compile(r"\$\$.*?\$\$|\\\[.*?\\\]|\\begin\{(?P<env>(?:equation|align|gather|multline)\*?)\}.*?\\end\{(?P=env)\}", re.S)


def _balance(s: str, left: str, right: str) -> str:
    """Drop right delimiters without a left one; close all that stay open. A line break isn't a delimiter."""
    out, at, depth = [], 0, 0
    for m in _TOKEN.finditer(s):
        if m[0] == right and depth == 0:
            out.append(s[at : m.start()])
            at = m.end()
        elif m[0] in (left, right):
            depth += 1 if m[0] == left else -1
    return "".join([*out, s[at:]]) + (("\n" + right if left == r"\[" else right) * depth)


def balance_display(s: str) -> str:
    return _balance(s, r"\[", r"\]")


def _paragraphs(s: str, f) -> str:
    return "".join(f(p) if k % 2 == 0 else p for k, p in enumerate(re.split(r"(\n\s*\n)", s)))


def balance_inline(s: str) -> str:
    return _paragraphs(s, lambda p: _balance(p, r"\(", r"\)"))


def balance_dollars(s: str) -> str:
    def one(p: str) -> str:
        marks = [m.start() for m in re.finditer(r"(?<![\\$])\$(?!\$)", p)]
        if len(marks) % 2 == 0:
            return p
        last = marks[-1]
        return p[:last] + p[last + 1 :] if not p[last + 1 :].strip(" .,;:\n") else p.rstrip() + "$" + p[len(p.rstrip()) :]

    return _paragraphs(s, one)


def balance_environments(s: str, names=_OUTER) -> str:
    """Ends without a begin go, begins without an end are closed in order."""
    token = re.compile(r"\\(begin|end)\{(" + "|".join(names) + r")(\*?)\}")
    out, at, stack = [], 0, []
    for m in token.finditer(s):
        env = m[2] + m[3]
        if m[1] == "begin":
            stack.append(env)
        elif env in stack:
            missing = []
            while stack[-1] != env:
                missing.append(f"\\end{{{stack.pop()}}}\n")
            stack.pop()
            out += [s[at : m.start()], *missing]
            at = m.start()
        else:
            out.append(s[at : m.start()])
            at = m.end()
    return "".join([*out, s[at:]]) + "".join(f"\n\\end{{{e}}}" for e in reversed(stack))


def heal_inner(s: str) -> str:
    """Inside display blocks, inner environments get their missing ends and lose spare ones."""
    return re.sub(r"(\\\[)(.*?)(\\\])", lambda m: m[1] + balance_environments(m[2], _INNER) + m[3], s, flags=re.S)


def unwrap_align(s: str) -> str:
    s = re.sub(r"\\\[\s*(\\begin\{(align\*?)\}.*?\\end\{\2\})\s*\\\]", r"\1", s, flags=re.S)
    return re.sub(r"\\begin\{equation\*?\}\s*(\\begin\{(align\*?)\}.*?\\end\{\2\})\s*\\end\{equation\*?\}", r"\1", s, flags=re.S)


def brackets_to_matrix(s: str) -> str:
    return re.sub(r"\\left\s*\[((?:(?!\\left|\\right).)*?&(?:(?!\\left|\\right).)*?)\\right\s*\]", r"\\begin{bmatrix}\1\\end{bmatrix}", s, flags=re.S)


def heal_text(s: str) -> str:
    s = re.sub(r"\\documentclass.*?\\begin\{document\}", "", re.sub(r"^\s*```(?:latex)?\s*|\s*```\s*$", "", s or ""), flags=re.S)
    s = re.sub(r"\\end\{document\}\s*$", "", s).replace("§", r"\S").replace("\u00a0", " ").strip()
    s = unwrap_align(s)
    s = re.sub(r"\\(min|max)imize\b", r"\\\1", s)
    s = brackets_to_matrix(s)
    s = re.sub(r"\$\$\s*(.*?)\s*\$\$", lambda m: "\\[\n" + m[1] + "\n\\]", s, flags=re.S)
    s = re.sub(r"(?<!\\)\\\\(begin|end)\{", r"\\\1{", s)
    return heal_inner(balance_environments(balance_dollars(balance_inline(balance_display(s))))).strip()


def hide_math(s: str) -> tuple[str, list[str]]:
    """Display formulas become numbered placeholders."""
    blocks: list[str] = []

    def put(m):
        blocks.append(m[0])
        return f"ZZZ_MATHBLOCK_{len(blocks) - 1:04d}_ZZZ"

    return _DISPLAY.sub(put, s or ""), blocks


def show_math(s: str, blocks: list[str]) -> str:
    return re.sub(r"ZZZ_MATHBLOCK_(\d{4,})_ZZZ", lambda m: blocks[int(m[1])] if int(m[1]) < len(blocks) else m[0], s)


def same_placeholders(a: str, b: str) -> bool:
    """The exact sequence of placeholders, each once."""
    x, y = (re.findall(r"ZZZ_MATHBLOCK_\d{4,}_ZZZ", t) for t in (a, b))
    return x == y and len(set(x)) == len(x)


def keep_tags(s: str, allowed: list[str]) -> str:
    """Tags of the list (all, if it is empty), each once."""
    seen: set[str] = set()

    def one(m):
        tag = re.sub(r"\s+", "", m[1].strip().strip("()[]"))
        if (allowed and tag not in allowed) or tag in seen:
            return ""
        seen.add(tag)
        return m[0]

    return re.sub(r"\\tag\{([^}]*)\}", one, s)


@F.arrow_udf(StringType())
def _heal(s: pa.Array) -> pa.Array:
    return pa.array([heal_text(t) for t in s.to_pylist()], pa.string())


def heal(c) -> Column:
    """The healed text; texts without a mark of TeX, a fence or a section sign are only stripped, in the JVM."""
    s = text(c)
    return F.when(s.rlike(r"[\\$`§]"), _heal(s)).otherwise(strip(F.translate(s, "\xa0", " ")))


@F.arrow_udf(BooleanType())
def placeholder_roundtrip(s: pa.Array) -> pa.Array:
    return pa.array([show_math(*hide_math(t)) == (t or "") for t in s.to_pylist()], pa.bool_())
