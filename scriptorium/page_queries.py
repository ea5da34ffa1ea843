"""Queries of page rules, labels, rendering, and of the indexes of equations and statements, with their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import pages as P
from .functions import records as R
from .functions import text as T
from .operators import equations
from .plans import book
from .queries import NUMBERED, query

# Documents with displays, tags, references and statements, from the lines of orders; the same text in Spark and here.
_B, _N = "chr(92)", "(l_orderkey % 20) || '.' || "
TEX_SQL = f"""case l_linenumber % 6
  when 1 then {_B} || '[ x_' || l_partkey || ' = ' || l_suppkey || ' ' || {_B} || 'tag{{' || {_N}(l_partkey % 9) || '}} ' || {_B} || ']'
  when 2 then 'By (' || {_N}(l_suppkey % 9) || ') and Theorem ' || (l_partkey % 7) || '.' || (l_suppkey % 3) || ' this holds.'
  when 3 then '$$ y_' || l_suppkey || ' ' || {_B} || 'qquad (' || {_N}(l_partkey % 9) || 'a) $$'
  when 4 then {_B} || 'begin{{align}} a &= b ' || {_B} || 'tag{{' || {_N}(l_partkey % 9) || '}} ' || {_B} || {_B} || ' c &= d ' || {_B} || 'tag{{' || {_N}(l_suppkey % 9) || 'b}} ' || {_B} || 'end{{align}}'
  when 5 then '%<BLOCK type=origintext label="Theorem ' || (l_partkey % 7) || '.' || (l_suppkey % 3) || '">' || chr(10) || 'Body ' || l_partkey || ' uses (' || {_N}(l_partkey % 9) || ').' || chr(10) || '%</BLOCK>'
  else '(' || {_N}(l_suppkey % 9) || ')' end"""
_TEX_LINES = f"m as (select l_orderkey doc_id, cast({NUMBERED} as integer) line_no, l_linenumber % 6 kind, l_partkey p, l_suppkey s, l_orderkey o, {TEX_SQL} line from lineitem)"
_TEX = f"{_TEX_LINES}, w as (select *, cast(coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as integer) place from m), d as (select doc_id, string_agg(line, chr(10) order by line_no) as text from m group by doc_id)"


def tex_documents(t):
    rows = t("lineitem").selectExpr("l_orderkey doc_id", f"cast({NUMBERED} as int) line_no", f"{TEX_SQL.replace('chr(', 'char(')} line")
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))


@query(rf"with {_TEX}, x as (select doc_id, unnest(regexp_extract_all(text, '\\tag\{{([^}}]+)\}}', 1)) tag, unnest(generate_series(1, len(regexp_extract_all(text, '\\tag\{{([^}}]+)\}}', 1)))) n from d), y as (select doc_id, tag, min(n) n from x group by all) select doc_id, tag, cast(row_number() over (partition by doc_id order by n) as integer) as nth from y")
def tag_definitions(t):
    return tex_documents(t).select("doc_id", F.posexplode(R.defined_tags("text")).alias("k", "tag")).select("doc_id", "tag", (F.col("k") + 1).alias("nth"))


@query(f"with {_TEX} select doc_id, place as position, line as block from w where kind in (1, 3, 4)")
def display_blocks(t):
    return equations.display_blocks(tex_documents(t))


_TAG_ROWS = rf"""x as (select doc_id, place, line, kind, unnest(regexp_extract_all(line, '\\tag\{{([^}}]+)\}}', 1)) tag from w where kind in (1, 4)),
f as (select doc_id, tag, min(place + position(chr(92) || 'tag{{' || tag || '}}' in line) - 1) as position, coalesce(arg_min(line, place) filter (kind = 1), arg_min(line, place) filter (kind = 4)) equation_full from x group by doc_id, tag)"""


@query(rf"""with {_TEX}, {_TAG_ROWS} select f.doc_id, tag, cast(position as integer) as position, equation_full, case when equation_full not like '%begin{{align}}%' then equation_full else '\begin{{align*}}' || chr(10) || list_filter(string_split(regexp_replace(equation_full, '^.begin\{{align\}} | .end\{{align\}}$', '', 'g'), ' ' || chr(92) || chr(92) || ' '), lambda r: contains(r, '\tag{{' || tag || '}}'))[1] || chr(10) || '\end{{align*}}' end as equation,
trim(regexp_replace(substring(text, cast(greatest(position - 240, 0) as integer) + 1, cast(position + 240 - greatest(position - 240, 0) as integer)), '\s+', ' ', 'g')) as content from f join d on d.doc_id = f.doc_id""")
def equation_index(t):
    return equations.equation_index(tex_documents(t)).select("doc_id", "tag", "position", "equation_full", "equation", "content")


@query(rf"""with {_TEX}, x as (select doc_id, place, line, kind, regexp_extract_all(line, '\\tag\{{([^}}]+)\}}', 1) own, regexp_extract_all(line, '\(\s*(\d+\.\d+[a-z]?)\s*\)', 1) hand from w where kind in (1, 3, 4)),
y as (select doc_id, place, line, unnest(case when len(own) > 0 then own else hand end) tag from x), z as (select * from y union select doc_id, place, line, regexp_replace(tag, '[a-z]$', '') from y)
select doc_id, tag, cast(min(place) as integer) as position, min(line) as equation_full from z group by doc_id, tag having count(distinct line) = 1""")
def fallback_index(t):
    return equations.equation_index(tex_documents(t), fallback=True).select("doc_id", "tag", "position", "equation_full")


@query(f"with {_TEX}, x as (select doc_id, place, 'theorem:' || (p % 7) || '.' || (s % 3) ref, 'Theorem ' || (p % 7) || '.' || (s % 3) display_ref, 'Body ' || p || ' uses (' || (o % 20) || '.' || (p % 9) || ').' as content from w where kind = 5) select doc_id, ref, min(display_ref) display_ref, arg_min(content, place) as content from x group by doc_id, ref")
def theorem_index(t):
    return equations.theorem_index(tex_documents(t))


@query()
def body_references(t):
    return equations.references(tex_documents(t)).select("doc_id", *(F.array_join(c, "|").alias(c) for c in ("refs", "evidence", "unresolved")))


@query()
def expand_references(t):
    return equations.expanded(tex_documents(t)).select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.array_join("notes", "|").alias("notes"))


@query()
def attach_numbers(t):
    return equations.numbered(tex_documents(t)).select("doc_id", F.sha2("text", 256).alias("text_sha256"), "moved")


# Lines that meet or miss each gate and rewrite.
PROBE_SQL = f"""case (l_orderkey + l_linenumber) % 16
  when 0 then {_B} || 'section{{Part ' || l_partkey || '}}' when 1 then '  ' || {_B} || 'begin{{thm}}[Name] Exercise ' || (l_partkey % 9) || '.' || (l_suppkey % 9) || ' shows' || {_B} || 'end{{thm}}'
  when 2 then 'a & b ' || {_B} || {_B} || ' c' when 3 then {_B} || 'frac{{' || l_partkey || '}}{{2}} = x ' || {_B} || 'qquad (' || (l_partkey % 30) || '.' || l_linenumber || ')'
  when 4 then '# Heading ' || l_suppkey || '  ' when 5 then 'SECTION ' || l_linenumber when 6 then '**' || (l_partkey % 9) || '.' || l_linenumber || '** Prove it' when 7 then ''
  when 8 then 'OCR to Markdown ' || l_suppkey when 9 then '[' || l_partkey || ', 2]' when 10 then '{{"k": ' || l_partkey || '}}' when 11 then '[]'
  when 12 then 'Fig. ' || l_partkey || ' ; a   plain , caption .' when 13 then {_B} || 'textbf{{Lemma ' || (l_partkey % 9) || '.' || l_linenumber || '}} and ' || {_B} || '(x' || {_B} || ')' || chr(10) || 'second line'
  when 14 then 'A, b ,' || l_partkey || ',, C' else 'plain words number ' || l_partkey || ' < y' end"""
_PROBE = f"q as (select l_orderkey doc_id, cast({NUMBERED} as integer) line_no, {PROBE_SQL} s from lineitem)"
_TRIM = r"regexp_replace(s, '^\s+|\s+$', '', 'g')"


def probes(t):
    return t("lineitem").selectExpr("l_orderkey doc_id", f"cast({NUMBERED} as int) line_no", f"{PROBE_SQL.replace('chr(', 'char(')} s")


@query(rf"""with {_PROBE}, r as (select *, {_TRIM} k, regexp_matches(s, '^\s*\\(section|subsection|subsubsection|chapter|paragraph|clearpage|newpage)') or regexp_matches(s, '^\s*% ===== Page') hard from q)
select doc_id, line_no, hard, hard or regexp_matches(s, '^\s*(\\begin\{{|%</?BLOCK\b)') structural,
 k <> '' and (regexp_matches(regexp_replace(k, '\*\*|__|`', '', 'g'), '(?i)^(Exercise\s+)?\d+(\.\d+)+\s*.*$') or regexp_matches(k, '(?i)^(SECTION|CHAPTER)\s+\d+$') or k like '#%') bounds,
 regexp_matches(s, '\\(frac|textbf\{{Lemma)') and (regexp_matches(s, '\\frac') or regexp_matches(s, '\\tag\*?\{{')) or contains(s, '&') and contains(s, '\\') math,
 (contains(s, '\\') or contains(s, '&')) aligned, k = '' or (length(k) < 120 and starts_with(lower(k), 'ocr to markdown')) bad,
 regexp_matches(s, '^\[\d|^\{{"') json from r""")
def page_gates(t):
    s = F.col("s")
    return probes(t).select("doc_id", "line_no", P.hard_boundary(s).alias("hard"), P.begins_structure(s).alias("structural"), P.bounds_markdown(s).alias("bounds"), P.math_block(s).alias("math"), P.needs_aligned(s).alias("aligned"), P.looks_bad(s).alias("bad"), P.json_filled(s).alias("json"))


@query(rf"""with {_PROBE}, r as (select *, {_TRIM} k from q), u as (select *, trim(regexp_replace(regexp_replace(s, '\\(?:textbf|emph|mathbf)\{{([^}}]*)\}}', '\1', 'g'), '\\[()\[\]]', '', 'g')) plain from r)
select doc_id, line_no, plain, trim(regexp_replace(regexp_replace('Figure 1 ' || s, '\s+([:;,\.])', '\1', 'g'), '\s{{2,}}', ' ', 'g')) caption,
 regexp_replace(regexp_replace(s, '\\begin\{{(?:defn|thm|lem|prop|cor|alg)\}}(?:\[[^\]]*\])?', '\\begin{{origintext}}', 'g'), '\\end\{{(?:defn|thm|lem|prop|cor|alg)\}}', '\\end{{origintext}}', 'g') origin,
 case when regexp_matches(k, '\\qquad \(\d+\.\d+\)$') then regexp_extract(k, '\((\d+\.\d+)\)$', 1) end as number,
 array_to_string(list_filter(list_transform(string_split(s, ','), lambda x: lower(trim(x))), lambda x: x <> ''), '|') as options from u""")
def page_rewrites(t):
    s = F.col("s")
    return probes(t).select("doc_id", "line_no", P.without_commands(s).alias("plain"), P.caption(F.lit("Figure 1"), s).alias("caption"), P.origin_environments(s).alias("origin"), P.tail_number(s)["number"].alias("number"), F.array_join(P.split_option(s), "|").alias("options"))


_LABEL = r"case when l_linenumber % 4 = 0 then 'proof' else 'thm' end"


@query(rf"""with {_PROBE}, r as (select *, {_TRIM} k from q), u as (select *, split_part(trim(regexp_replace(regexp_replace(k, '\\(?:textbf|emph|mathbf)\{{([^}}]*)\}}', '\1', 'g'), '\\[()\[\]]', '', 'g')), chr(10), 1) line from r),
l as (select *, case when line_no % 4 = 0 then 'Proof' when regexp_matches(s, 'Exercise \d+\.\d+') then 'Exercise ' || regexp_extract(s, 'Exercise (\d+\.\d+)', 1) when line = '' then 'UNKNOWN' else line end as label from u)
select doc_id, line_no, label, '%<BLOCK type=thm label="' || replace(replace(label, '\', '\\'), '"', '\"') || case when line_no % 2 = 0 then '" part="b">' else '">' end as header,
 '\begin{{thm}}' || chr(10) || case when k = '' then '' else k || chr(10) end || '\end{{thm}}' as env, case when line_no = 1 then '\section{{' when line_no = 2 then '\subsection{{' else '\subsubsection{{' end || case when line_no = 1 then '1' when line_no = 2 then '1.2' else '1.2.3' end || '. T}}' as heading,
 case when regexp_matches(s, 'Lemma \d') then 'lemma:' || regexp_extract(s, 'Lemma (\d+\.\d+)', 1) else '' end as ref, case when regexp_matches(s, 'Lemma \d') then 'lem:' || regexp_extract(s, 'Lemma (\d+\.\d+)', 1) else '' end as ref_key from l""")
def block_labels(t):
    s = F.col("s")
    env = F.when(F.col("line_no") % 4 == 0, "proof").otherwise("thm")
    rows = probes(t).select("doc_id", "line_no", "s", P.block_label(env, s).alias("label"), P.label_statement(s).alias("ref"))
    number = F.when(F.col("line_no") == 1, "1").when(F.col("line_no") == 2, "1.2").otherwise("1.2.3")
    return rows.select("doc_id", "line_no", "label", P.block_open(F.lit("thm"), F.col("label"), part=F.when(F.col("line_no") % 2 == 0, "b")).alias("header"), P.environment(F.lit("thm"), s).alias("env"), P.numbered_heading(number, F.lit("T")).alias("heading"), "ref", P.statement_key(F.col("ref")).alias("ref_key"))


@query()
def page_scores(t):
    s = F.col("text")
    return t("documents").select("doc_id", P.page_score(s, T.bracket_errors(F.substring(s, 1, 8000)), F.lit(False), F.lit(False)).alias("score"), P.pathological(s).alias("pathological"), F.coalesce(P.reject_reason(s), F.lit("")).alias("reason"), P.running_headers(s)["removed"].alias("removed"))


# TeX with statements and proofs, four layouts of the same exercises: nested sentinels, untagged proofs, environments alone, no parts.
RECORD_COLUMNS = [
    "l_orderkey doc_id",
    f"cast({NUMBERED} as integer) n",
    "l_orderkey % 4 layout",
    "'3.' || (l_orderkey % 50) exercise",
    "'Exercise 3.' || (l_orderkey % 50) || ' Given order ' || l_orderkey || '.' stem",
    "case when l_returnflag = 'R' then 'Compute' else 'Show' end || ' item ' || l_partkey || '.' statement",
    "'It is ' || l_suppkey || '.' proof",
    "'lemma:' || (l_partkey % 9) || '.1' ref",
]
_RECORDS = f"m as (select {', '.join(RECORD_COLUMNS)} from lineitem)"
PIECES = [
    """case when layout = 3 then statement else '%<BLOCK type=subpart_statement exercise="' || exercise || '" part=' || chr(96 + n) || ' refs="' || ref || ', Lem: 7; none">' || chr(10) || statement || chr(10) || '%</BLOCK>' end s""",
    """case layout when 3 then proof when 1 then '%<BLOCK type=proof label="Proof">' || chr(10) || proof || chr(10) || '%</BLOCK>'
    else '%<BLOCK type=subpart_proof exercise="' || exercise || '" part="' || chr(96 + case when n = 3 then 2 else n end) || '">' || chr(10) || proof || chr(10) || '%</BLOCK>' end p""",
]


def exercise_documents(t):
    rows = t("lineitem").selectExpr(*RECORD_COLUMNS).selectExpr("doc_id", "n", "layout", "stem", "exercise", *(x.replace("chr(", "char(") for x in PIECES))
    joined = lambda c: F.array_join(F.transform("rows", lambda x: x[c]), "\n")
    docs = rows.groupBy("doc_id", "layout", "stem", "exercise").agg(F.array_sort(F.collect_list(F.struct("n", "s", "p"))).alias("rows"))
    block = lambda kind, label, *x: F.concat_ws("\n", F.concat(F.lit(f'%<BLOCK type={kind} label="'), label, F.lit('">')), *x, F.lit("%</BLOCK>"))
    env = lambda kind, *x: F.concat_ws("\n", F.lit(f"\\begin{{{kind}}}"), *x, F.lit(f"\\end{{{kind}}}"))
    thm, label = env("thm", F.col("stem"), joined("s")), F.concat(F.lit("Exercise "), "exercise")
    text = F.when(F.col("layout") == 2, F.concat_ws("\n", thm, env("proof", joined("p"))))
    text = text.when(F.col("layout") == 1, F.concat_ws("\n", block("thm", label, thm), joined("p")))
    return docs.select("doc_id", text.otherwise(F.concat_ws("\n", block("thm", label, thm), block("proof", F.lit("Proof"), env("proof", joined("p"))))).alias("text"))


@query(rf"""with {_RECORDS}, r as (select doc_id, n as index, 'Exercise ' || exercise || '-(' || chr(96 + n) || ')' source_idx, stem || chr(10) || chr(10) || statement problem, proof, proof as last, ref || '|lemma:7' theorem_refs from m where layout <> 3
 union all select doc_id, 1, 'Exercise ' || min(exercise), min(stem) || chr(10) || string_agg(statement, chr(10) order by n), string_agg(proof, chr(10) order by n), arg_max(proof, n), '' from m where layout = 3 group by doc_id)
select doc_id, index, source_idx, problem, proof, case when contains(problem, 'Compute') then '\[' || chr(10) || last || chr(10) || '\]' else '' end direct_answer, case when contains(problem, 'Compute') then '求值题' else '证明题' end as type, theorem_refs, problem problem_with_context from r""")
def tex_records(t):
    rows = book.tex_records(exercise_documents(t))
    return rows.select("doc_id", "index", "source_idx", "problem", "proof", "direct_answer", F.element_at("题目类型", 1).alias("type"), F.array_join("theorem_refs", "|").alias("theorem_refs"), "problem_with_context")
