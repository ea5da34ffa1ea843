"""One query per operator over whole tables, with its SQL equivalent for DuckDB."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions import latex
from .functions import records as R
from .functions import text as T
from .operators import enrich, index, lines, merge, records, segment
from .plans import book

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Shared pieces of SQL

LINES = r"""l as (select doc_id, cast(unnest(generate_series(1, len(a))) as integer) as line_no, unnest(a) as line from (
  select doc_id, string_split(case when right(text, 1) = chr(10) then left(text, length(text) - 1) else text end, chr(10)) a from documents where text <> ''))"""
KEY = r"lower(trim(regexp_replace(line, '\s+', ' ', 'g')))"
# Markup made of orders' lines, the same in Spark and here.
MARK_SQL = """case when l_linenumber = 1 then '**' || (l_orderkey % 50) || '.' || (l_partkey % 20) || '** Show that part ' || l_partkey || ' holds.'
  when l_returnflag = 'R' then 'Solution.' when l_returnflag = 'A' then '(' || chr(96 + l_linenumber) || ') case ' || l_partkey else 'text ' || l_suppkey end"""
NUMBERED = "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
MARKUP = f"m as (select l_orderkey doc_id, cast({NUMBERED} as integer) line_no, {MARK_SQL} line from lineitem)"
NEST_SQL = "case when l_linenumber % 3 = 1 then '%<BLOCK type=' || case when l_returnflag = 'R' then 'proof' else 'thm' end || ' label=\"Exercise ' || (l_orderkey % 50) || '.' || (l_partkey % 20) || '\" part=' || l_linenumber || '>' when l_linenumber % 3 = 0 then '%</BLOCK>' else 'body ' || l_partkey end"
NESTED = f"m as (select l_orderkey doc_id, cast({NUMBERED} as integer) line_no, {NEST_SQL} line from lineitem)"
# Slots: exercises and parts from orders' lines.
SLOT_COLUMNS = [
    "l_orderkey doc_id",
    f"cast({NUMBERED} as integer) ord",
    "(l_orderkey % 30) || '.' || (l_partkey % 9) exercise",
    "case when l_linenumber % 2 = 0 then chr(cast(97 + l_suppkey % 5 as integer)) else '' end part",
    "case when l_returnflag = 'R' then 'proof' else 'problem' end field",
    "'Value ' || l_partkey value",
]
SLOT_SQL = f"select {', '.join(SLOT_COLUMNS)} from lineitem"


def markup(t, expr=MARK_SQL):
    return t("lineitem").selectExpr("l_orderkey doc_id", f"cast({NUMBERED} as int) line_no", f"{expr.replace('chr(', 'char(')} line")


def slots(t):
    return t("lineitem").selectExpr(*(c.replace("chr(", "char(") for c in SLOT_COLUMNS))


# Lines


@query(f"with {LINES} select doc_id, line_no, line from l")
def line_table(t):
    return lines.line_table(t("documents"))


@query(rf"with {LINES} select doc_id, cast(count(*) as bigint) n_lines, cast(count_if(regexp_matches(line, '\S')) as bigint) n_filled from l group by doc_id")
def nonblank_lines(t):
    return lines.line_table(t("documents")).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(T.strip(F.col("line")) != "").alias("n_filled"))


REPEAT = rf"""k as (select doc_id, {KEY} k from l where regexp_matches(line, '\S')),
n as (select doc_id, case when length(k) >= 24 then k end k, count(*) n from k group by all),
r as (select doc_id, cast(sum(n) as bigint) n_lines, cast(coalesce(max(case when k is not null then n end), 0) as bigint) max_rep from n group by doc_id)"""


@query(f"with {LINES}, {REPEAT} select *, n_lines >= 12 and max_rep > 0 and (max_rep >= 6 or max_rep * 4 >= n_lines) heavy from r")
def line_repetition(t):
    return lines.repetition(lines.line_table(t("documents")))


@query(f"with {LINES}, {REPEAT} select d.doc_id, coalesce(n_lines >= 12 and max_rep > 0 and (max_rep >= 6 or max_rep * 4 >= n_lines), false) heavy from documents d left join r on r.doc_id = d.doc_id")
def line_repetition_gate(t):
    return t("documents").select("doc_id", T.has_heavy_repetition("text").alias("heavy"))


SQUASH = rf"""a as (select *, case when length({KEY}) >= 24 then {KEY} end k from l),
b as (select *, case when k = lag(k) over (partition by doc_id order by line_no) then 0 else 1 end s from a),
g as (select *, sum(s) over (partition by doc_id order by line_no) g from b),
q as (select *, row_number() over (partition by doc_id, g order by line_no) n from g where true)"""


@query(f"with {LINES}, {SQUASH} select doc_id, line_no, line from q where k is null or n <= 2")
def squash_repeated_lines(t):
    return lines.squash(lines.line_table(t("documents")))


@query(rf"with {LINES}, {SQUASH} select d.doc_id, coalesce(regexp_replace(string_agg(line, chr(10) order by line_no) filter (where k is null or n <= 2), '^\s+|\s+$', '', 'g'), '') clean from documents d left join q on q.doc_id = d.doc_id group by d.doc_id")
def squash_text(t):
    return t("documents").select("doc_id", T.squash_repeats("text").alias("clean"))


@query(rf"with {LINES} select doc_id, line_no, line from l where not regexp_matches(line, '(?:\b\d+\.\s*){{80}}')")
def drop_runaway_lines(t):
    return lines.line_table(t("documents")).where(~F.col("line").rlike(r"(?:\b\d+\.\s*){80}"))


LEAKS = "|".join(T.LEAK_LINES).replace("'", "''")


@query(rf"with {LINES} select doc_id, line_no from l where regexp_matches(trim(line), '(?i)(?:{LEAKS})')")
def leaked_lines(t):
    return lines.line_table(t("documents")).where(T.any_of(T.strip(F.col("line")), T.LEAK_LINES)).select("doc_id", "line_no")


@query(rf"""with {LINES}, f as (select doc_id, string_agg(line, chr(10) order by line_no) s from l where not regexp_matches(line, '(?i)^\s*\[\s*figure(?:\s*:[^\]]*)?\s*\]\s*$') group by doc_id)
select d.doc_id, coalesce(regexp_replace(regexp_replace(s, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g'), '') clean from documents d left join f on f.doc_id = d.doc_id""")
def drop_figures(t):
    return t("documents").select("doc_id", T.drop_figures("text").alias("clean"))


@query(r"select doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) squeezed, case when length(trim(regexp_replace(text, '\s+', ' ', 'g'))) <= 320 then trim(regexp_replace(text, '\s+', ' ', 'g')) else rtrim(left(trim(regexp_replace(text, '\s+', ' ', 'g')), 319)) || '…' end compact from documents")
def compact_text(t):
    return t("documents").select("doc_id", T.squeeze(F.col("text")).alias("squeezed"), T.compact("text").alias("compact"))


@query(r"""with s as (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') s from documents)
select doc_id, case when length(s) <= 2000 then s else left(s, 1000) || chr(10) || '...' || chr(10) || right(s, 1000) end cut from s""")
def truncate_middle(t):
    return t("documents").select("doc_id", T.truncate_middle("text", 2000).alias("cut"))


@query("select page_id, replace(replace(replace(html, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n') escaped from pages")
def escape_attributes(t):
    return t("pages").select("page_id", T.escape_attr("html").alias("escaped"))


# Gates and scores


@query(r"""with s as (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') s from documents)
select doc_id, s <> '' and not regexp_matches(s, '[一-鿿]') and len(regexp_extract_all(s, '[A-Za-z]+(?:''[A-Za-z]+)?')) >= 6
and len(regexp_extract_all(s, '\p{L}')) > 0 and len(regexp_extract_all(s, '[A-Za-z]')) >= 0.6 * len(regexp_extract_all(s, '\p{L}')) ok from s""")
def english_quality(t):
    return t("documents").select("doc_id", T.english_ok("text").alias("ok"))


@query(r"select doc_id, regexp_matches(text, '[一-鿿]') or not regexp_matches(text, '\S') flagged from documents")
def cjk_gate(t):
    return t("documents").select("doc_id", T.not_english("text").alias("flagged"))


@query(rf"select page_id, not regexp_matches(html, '\S') or regexp_matches(left(regexp_replace(html, '^\s+|\s+$', '', 'g'), 1000), '{T.LAYOUT}') layout from pages")
def layout_gate(t):
    return t("pages").select("page_id", T.is_layout("html").alias("layout"))


PROMPTS = " or ".join(f"contains(lower(text), '{m}')" for m in T.PROMPT_MARKERS)


@query(f"select doc_id, {PROMPTS} leaked, regexp_matches(text, '(?i)(?:{'|'.join(T.LEAK_PATTERNS)})') polluted from documents")
def prompt_leak_gate(t):
    return t("documents").select("doc_id", T.has_prompt_marks("text").alias("leaked"), T.has_prompt_leak("text").alias("polluted"))


@query(rf"""with {LINES}, {REPEAT}, d as (select documents.doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') s, {PROMPTS} leak, coalesce(n_lines >= 12 and max_rep > 0 and (max_rep >= 6 or max_rep * 4 >= n_lines), false) heavy from documents left join r on r.doc_id = documents.doc_id)
select doc_id, cast(2000 + case when length(s) < 20 then -1000 when length(s) < 80 then -300 when length(s) <= 14000 then least(1800, length(s) // 6) else -least(2200, (length(s) - 14000) // 10) end
 - case when s = '' or regexp_matches(left(s, 1000), '{T.LAYOUT}') then 80 else 0 end - case when leak then 3000 else 0 end - case when regexp_matches(s, '(?:\b\d+\.\s*){{120}}') then 3000 else 0 end - case when heavy then 2200 else 0 end as integer) score from d""")
def quality_score(t):
    return t("documents").select("doc_id", T.score("text", F.lit(False), F.lit(None), T.is_layout("text")).alias("score"))


@query()
def bad_reason(t):
    return t("documents").select("doc_id", T.first_bad_reason("text").alias("reason")).select("doc_id", "reason", T.penalty(F.col("reason")).alias("penalty"))


@query(r"""with {L}, p as (select doc_id, length(trim(line)) n from l where regexp_matches(line, '\S')), a as (select doc_id, count(*) n, sum(n) s, count_if(n <= 35) a, count_if(n <= 18) b from p group by doc_id)
select d.doc_id, coalesce(length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 400 and n >= 40 and ((a / n >= 0.55 and s / n <= 55) or (b / n >= 0.30 and s / n <= 65)), false) interleaved from documents d left join a on a.doc_id = d.doc_id""".replace("{L}", LINES))
def interleaved_columns(t):
    return t("documents").select("doc_id", F.coalesce(T.interleaved_columns("text"), F.lit(False)).alias("interleaved"))


@query()
def bracket_balance(t):
    return t("pages").select("page_id", T.bracket_errors("html").alias("errors"), T.unbalanced_display("html").alias("open_display"))


@query(rf"""with {LINES}, s as (select doc_id, line_no, regexp_replace(line, '^\s+|\s+$', '', 'g') s from l)
select doc_id, line_no, s <> '' and length(s) <= 90 and not suffix(s, '.') and regexp_matches(s, '[A-Za-z]') and not regexp_matches(s, '(?i)\b(is|are|was|were|have|has|that|which|whenever)\b') title,
regexp_matches(regexp_replace(s, '(?i)^(Equivalently|Also|Then|Next|Moreover|Furthermore|Hence|Thus|Finally)\s*,?\s+', ''), '(?i)^(Prove|Show|Find|Compute|Derive|Determine|Verify|Establish|Evaluate|Minimize|Maximize)\b') task from s""")
def title_and_task_lines(t):
    return lines.line_table(t("documents")).select("doc_id", "line_no", T.short_title("line").alias("title"), T.task_sentence("line").alias("task"))


@query("""select source, lang, cast(count(*) as bigint) docs, cast(sum(n_chars) as bigint) chars from documents group by rollup(source, lang)""")
def report_rollup(t):
    return t("documents").rollup("source", "lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query()
def quality_report(t):
    return book.quality_report(t("documents"))


# Pages

PAGED = "p as (select conv_id doc_id, string_agg('<!--' || repeat(' ', cast(turn % 3 as integer)) || 'PAGE  ' || turn || '-->' || chr(10) || text, chr(10) order by turn, text) text from conversations group by conv_id)"


def paged(t):
    rows = t("conversations").select("conv_id", F.struct("turn", "text").alias("o"), F.concat(F.expr("concat('<!--', repeat(' ', cast(turn % 3 as int)), 'PAGE  ', turn, '-->')"), F.lit("\n"), "text").alias("v"))
    return lines.assemble(rows, "conv_id", "o", "v").withColumnRenamed("conv_id", "doc_id")


@query(r"select conv_id doc_id, cast(turn as integer) page, regexp_replace(text, '^\s+|\s+$', '', 'g') md from conversations")
def page_split(t):
    return segment.split_pages(paged(t), "doc_id", "text")


@query(f"with {PAGED} select doc_id, text from p")
def page_assemble(t):
    return paged(t)


@query("with p as (select conv_id doc_id, max(turn) last from conversations group by conv_id) select doc_id, last >= doc_id % 5 complete from p")
def doc_complete(t):
    return paged(t).select("doc_id", T.pages_complete("text", F.col("doc_id") % 5).alias("complete"))


# Segmentation


@query(rf"with {MARKUP} select doc_id, line_no, case when regexp_matches(line, '^\*\*') then regexp_replace(line, '^\*\*(\d+\.\d+)\*\* (.*)$', '**Exercise \1** \2') else line end line from m")
def exercise_headers(t):
    return markup(t).select("doc_id", "line_no", T.exercise_header(F.col("line")).alias("line"))


SESSIONS = rf"""{MARKUP}, a as (select *, case when starts_with(line, '**') then 'Exercise ' || regexp_extract(line, '\*\*(\d+\.\d+)\*\*', 1) end ex, line = 'Solution.' sol from m),
b as (select *, coalesce(ex, case when sol then 'proof' end) mark from a),
c as (select *, last_value(mark ignore nulls) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding) was from b),
d as (select *, mark is not null and mark is not distinct from was same from c),
e as (select *, sum(case when (mark is not null and not same) or line_no = 1 then 1 else 0 end) over (partition by doc_id order by line_no) ord,
 case when ex is not null then case when same then '' else ex || chr(10) end || regexp_extract(line, '\*\* (.*)$', 1) else line end o from d)"""


@query(f"with {SESSIONS} select doc_id, cast(ord as integer) ord, arg_min(case when sol then 'proof' when ex is not null then 'exercise' else 'para' end, line_no) kind, case arg_min(case when sol then 'proof' when ex is not null then 'exercise' else 'para' end, line_no) when 'proof' then 'proof' when 'exercise' then 'thm' end env, string_agg(o, chr(10) order by line_no) md from e group by doc_id, ord")
def block_sessionize(t):
    return segment.sessionize(markup(t))


@query(rf"""with {MARKUP}, a as (select *, lower(regexp_extract(line, '^\(\s*([A-Za-z])\s*\)', 1)) p from m), b as (select *, sum(case when p <> '' then 1 else 0 end) over (partition by doc_id order by line_no) ord from a)
select doc_id, cast(ord as integer) ord, max(p) part, string_agg(line, chr(10) order by line_no) md from b group by doc_id, ord""")
def subpart_split(t):
    return segment.split_subparts(markup(t))


@query(f"with {MARKUP} select doc_id, cast(count_if(line = 'Solution.') as integer) n from m group by doc_id")
def solution_markers(t):
    docs = lines.assemble(markup(t), "doc_id", "line_no", "line")
    return docs.select("doc_id", segment.solution_markers("text").alias("n"))


@query(rf"""with {MARKUP}, a as (select *, lower(regexp_extract(line, '^\(\s*([A-Za-z])\s*\)', 1)) p, line = 'Solution.' s from m),
b as (select *, min(case when s then line_no end) over w ns, min(case when p <> '' then line_no end) over w np from a window w as (partition by doc_id order by line_no rows between 1 following and unbounded following)),
c as (select *, row_number() over (partition by doc_id, p order by line_no) n from b where p <> '' and ns is not null and (np is null or ns < np))
select doc_id, p part, line_no first_line, cast(ns - 1 as integer) last_line from c where n = 1""")
def interleaved_statements(t):
    return segment.interleaved_statements(markup(t))


DEPTH = f"""{NESTED}, a as (select *, starts_with(line, '%<BLOCK') open, line = '%</BLOCK>' close from m),
b as (select *, sum(cast(open as int) - cast(close as int)) over (partition by doc_id order by line_no) s from a),
c as (select *, s - least(0, min(s) over (partition by doc_id order by line_no)) depth from b),
d as (select *, coalesce(lag(depth) over (partition by doc_id order by line_no), 0) was from c),
e as (select *, sum(case when open and was = 0 then 1 else 0 end) over (partition by doc_id order by line_no) r from d)"""


@query(f"with {DEPTH} select doc_id, line_no, line, open, close, cast(depth as integer) depth, cast(case when depth > 0 or was > 0 then r end as integer) root from e")
def block_depth(t):
    return segment.nesting(markup(t, NEST_SQL))


TOP = f"{DEPTH}, f as (select doc_id, cast(r as integer) root, min(line_no) first_line, arg_min(line, line_no) header, arg_max(depth, line_no) d, string_agg(line, chr(10) order by line_no) raw from e where depth > 0 or was > 0 group by doc_id, r)"


@query(f"with {TOP} select doc_id, root, first_line, header, raw from f")
def top_level_blocks(t):
    return segment.top_blocks(markup(t, NEST_SQL))


@query(f"with {TOP} select doc_id, root, first_line, header, raw from f where d = 0")
def closed_blocks(t):
    return segment.top_blocks(markup(t, NEST_SQL), unclosed=False)


@query(rf"with {NESTED} select doc_id, line_no, regexp_extract(line, 'type=(\w+)', 1) as type, regexp_extract(line, 'label=\"([^\"]*)\"', 1) as label, regexp_extract(line, 'part=(\d+)', 1) part from m where starts_with(line, '%<BLOCK')")
def attrs_map(t):
    head = markup(t, NEST_SQL).where(F.col("line").rlike(segment.BLOCK_OPEN))
    a = F.col("a")  # a column of its own, so that it's made once for the three
    return head.select("doc_id", "line_no", segment.attributes(F.regexp_extract("line", segment.BLOCK_OPEN, 1)).alias("a")).select("doc_id", "line_no", a["type"].alias("type"), a["label"].alias("label"), a["part"].alias("part"))


# Order and joins


@query(rf"with {MARKUP}, a as (select *, nullif(regexp_extract(line, '\*\*(\d+\.\d+)\*\*', 1), '') ex from m) select doc_id, line_no, last_value(ex ignore nulls) over (partition by doc_id order by line_no) exercise from a")
def exercise_forward_fill(t):
    m = markup(t).withColumn("n", R.exercise_number(T.exercise_header(F.col("line"))))
    return records.forward_fill(m, "doc_id", "line_no", "n", "exercise").select("doc_id", "line_no", "exercise")


@query("""select o_custkey, o_orderkey, (select max(b.o_orderkey) from orders b where b.o_custkey = a.o_custkey and b.o_orderkey < a.o_orderkey and b.o_orderstatus = 'F') latest from orders a where o_orderstatus <> 'F'""")
def asof_exercise(t):
    o = t("orders")
    marks = o.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", F.col("o_orderkey").alias("latest"))
    return index.as_of(o.where("o_orderstatus <> 'F'"), marks, "o_custkey", "o_orderkey", "latest").select("o_custkey", "o_orderkey", "latest")


@query(f"with {MARKUP}, a as (select *, lead(line) over (partition by doc_id order by line_no) nxt from m) select doc_id, line_no, nxt = 'Solution.' has_proof from a where starts_with(line, '**') and nxt is not null")
def next_proof(t):
    m = markup(t).withColumn("nxt", F.lead("line").over(Window.partitionBy("doc_id").orderBy("line_no")))
    return m.where("startswith(line, '**') and nxt is not null").select("doc_id", "line_no", segment.solution_start(F.col("nxt")).alias("has_proof"))


@query("""with s as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) n from orders where o_orderstatus = 'O'), p as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) n from orders where o_orderstatus = 'F')
select s.o_custkey, s.o_orderkey as statement, p.o_orderkey proof from s join p on s.o_custkey = p.o_custkey and s.n = p.n""")
def fifo_pairing(t):
    o = t("orders")
    return records.fifo(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), "o_custkey", "o_orderkey")


# Records

SLOTS = f"s as ({SLOT_SQL})"


@query(f"""with {SLOTS} select doc_id, exercise, part, coalesce(arg_max(value, ord) filter (where field = 'problem'), '') problem, coalesce(arg_max(value, ord) filter (where field = 'proof'), '') proof from s group by all""")
def slot_upsert(t):
    s = slots(t).select(F.struct("doc_id", "exercise").alias("exercise"), "part", "field", "value", F.array("value").alias("refs"), "ord")
    return records.upsert(s).select("exercise.doc_id", "exercise.exercise", "part", "problem", "proof")


@query(f"with {SLOTS} select doc_id, arg_max(value, length(value) * 1000000 - ord) value from s group by doc_id")
def longest_prefix(t):
    return records.longest_prefix(slots(t), "doc_id", "value", "ord")


def part_rows(t):
    """Parts of all orders' exercises, keyed by document and exercise."""
    return slots(t).where("part <> ''").select(F.concat("doc_id", F.lit(":"), "exercise").alias("exercise"), "part", F.when(F.col("field") == "problem", F.col("value")).alias("problem"), F.when(F.col("field") == "proof", F.col("value")).alias("proof"))


@query(f"""with {SLOTS}, g as (select doc_id || ':' || exercise exercise, coalesce(list_sort(list_distinct(list(part) filter (where field = 'problem'))), []) a, coalesce(list_sort(list_distinct(list(part) filter (where field = 'proof'))), []) b from s where part <> '' group by 1)
select exercise, array_to_string(a, ',') statement_parts, array_to_string(b, ',') proof_parts, array_to_string(list_filter(a, lambda x: not list_contains(b, x)), ',') missing_proof from g""")
def coverage_sets(t):
    c = records.coverage(part_rows(t))
    return c.select("exercise", *(F.array_join(x, ",").alias(x) for x in ("statement_parts", "proof_parts", "missing_proof")))


MISMATCH = f"""{SLOTS}, g as (select exercise, list_sort(list_distinct(list(part) filter (where field = 'problem'))) a, list_sort(list_distinct(list(part) filter (where field = 'proof'))) b from (select doc_id || ':' || exercise exercise, part, field from s where part <> '') group by exercise),
w as (select exercise, coalesce(array_to_string(a, ','), '') statement_parts, coalesce(array_to_string(b, ','), '') proof_parts from g)"""


@query(f"with {MISMATCH} select * from w where statement_parts <> proof_parts")
def subpart_mismatch(t):
    rows = slots(t).select(F.concat("doc_id", F.lit(":"), "exercise").alias("exercise"), "part", F.when(F.col("field") == "problem", F.col("value")).alias("problem"), F.when(F.col("field") == "proof", F.col("value")).alias("proof"))
    return records.mismatches(rows).select("exercise", F.array_join("statement_parts", ",").alias("statement_parts"), F.array_join("proof_parts", ",").alias("proof_parts"))


def record_rows(t):
    r = slots(t).withColumn("problem", F.expr("case when ord % 5 = 0 then '' else value end")).withColumn("proof", F.expr("case when field = 'proof' then value else '' end"))
    return r.select("doc_id", F.col("ord").alias("index"), R.source_idx(F.col("exercise"), F.col("part")).alias("source_idx"), "problem", "proof", F.array(F.expr("case when ord % 6 = 0 then 'x' else '其他' end")).alias("题目类型"))


@query(f"""with {SLOTS}, r as (select doc_id, ord, exercise, part, 'Exercise ' || exercise || case when part <> '' then '-(' || part || ')' else '' end sid, case when ord % 5 = 0 then '' else value end problem, case when field = 'proof' then value else '' end proof, ord % 6 = 0 badtype from s),
x as (select *, row_number() over (partition by doc_id, sid order by ord) n, bool_or(part <> '' and proof <> '') over (partition by doc_id, exercise) sub from r),
p as (select doc_id, exercise, coalesce(list_sort(list_distinct(list(part) filter (where problem <> ''))), []) a, coalesce(list_sort(list_distinct(list(part) filter (where proof <> ''))), []) b from r where part <> '' group by doc_id, exercise)
select doc_id, 'duplicate_source_idx' as type, sid as key from x where n > 1 union all select doc_id, 'missing_problem', sid from x where problem = '' union all
select doc_id, 'missing_proof', sid from x where proof = '' and not (part = '' and sub) union all select doc_id, 'invalid_problem_type', sid from x where badtype union all
select doc_id, 'subpart_mismatch', exercise from p where a <> b""")
def validate_records(t):
    return records.validate(record_rows(t), by="doc_id").select("doc_id", "type", F.coalesce("source_idx", "exercise").alias("key"))


@query(f"with {SLOTS}, k as (select doc_id, ord, exercise || '|' || part sid from s) select doc_id, ord, sid from (select *, row_number() over (partition by doc_id, sid order by ord) n from k) where n > 1")
def duplicate_ids(t):
    s = slots(t).select("doc_id", "ord", F.concat("exercise", F.lit("|"), "part").alias("sid"))
    return s.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "sid").orderBy("ord"))).where("n > 1").drop("n")


@query(f"""with {SLOTS} select doc_id, ord, exercise, part, cast(row_number() over (partition by doc_id order by cast(split_part(exercise, '.', 1) as int), cast(split_part(exercise, '.', 2) as int), case when part = '' then 1000000 else ascii(part) - 97 end, exercise, part, ord) as integer) as index from s""")
def natural_sort_index(t):
    w = Window.partitionBy("doc_id").orderBy(R.sort_key(F.col("exercise"), F.col("part")), "ord")
    return slots(t).select("doc_id", "ord", "exercise", "part", F.row_number().over(w).alias("index"))


@query("select o_orderkey, o_totalprice > 100000 and row_number() over (partition by o_custkey, coalesce(o_totalprice > 100000, false) order by o_orderkey) <= 3 selected from orders")
def budget_limit(t):
    return records.budget(t("orders"), F.col("o_totalprice") > 100000, "o_orderkey", 3, ["o_custkey"]).select("o_orderkey", "selected")


@query("select source, arg_max(doc_id, n_chars * 10000000000 - doc_id) doc_id, max(n_chars) n_chars from documents group by source")
def best_candidate(t):
    return records.best(t("documents").select("source", "doc_id", "n_chars", F.col("doc_id").alias("o")), "source", "n_chars", "o").drop("o")


# References


@query(r"""with r as (select page_id, unnest(regexp_extract_all(html, '\((\d+(?:\.\d+)*(?:[A-Za-z])?)\)', 1)) ref from pages) select page_id, ref from r group by all""")
def bare_refs(t):
    return t("pages").select("page_id", F.explode(R.bare_refs("html")).alias("ref"))


@query("""with i as (select p_partkey % 400 tag, min(p_name) as name from part where p_partkey % 3 > 0 group by 1) select o_orderkey, cast(o_custkey % 400 as bigint) tag, i.name, i.name is not null resolved from orders left join i on i.tag = o_custkey % 400""")
def resolve_refs(t):
    idx = t("part").where("p_partkey % 3 > 0").groupBy((F.col("p_partkey") % 400).alias("tag")).agg(F.min("p_name").alias("name"))
    return index.resolve(t("orders").select("o_orderkey", (F.col("o_custkey") % 400).alias("tag")), idx, ["tag"], "name").select("o_orderkey", "tag", "name", "resolved")


@query("""select o_orderkey, (o_custkey % 40) || '.' || (o_orderkey % 9) || chr(cast(c as integer)) tag from (select *, unnest(generate_series(97, 97 + o_custkey % 5)) c from orders)""")
def range_expand(t):
    base = "concat(o_custkey % 40, '.', o_orderkey % 9)"
    s = t("orders").select("o_orderkey", F.expr(f"concat('see (', {base}, 'a)--(', {base}, char(97 + o_custkey % 5), ')')").alias("s"))
    return s.select("o_orderkey", F.explode(R.range_refs("s")).alias("tag"))


@query("""with i as (select distinct (p_partkey % 50) || '.' || (p_size % 7) || chr(97 + p_size % 3) tag from part union select distinct (p_partkey % 50) || '.1' from part where p_partkey % 2 = 0),
r as (select o_orderkey, (o_custkey % 50) || '.' || (o_orderkey % 7) tag from orders) select o_orderkey, r.tag, i.tag expanded from r join i on i.tag[:-2] = r.tag and regexp_matches(i.tag, '[a-z]$') where r.tag not in (select tag from i)""")
def suffix_expand(t):
    a = t("part").selectExpr("concat(p_partkey % 50, '.', p_size % 7, char(97 + p_size % 3)) tag")
    idx = a.union(t("part").where("p_partkey % 2 = 0").selectExpr("concat(p_partkey % 50, '.1') tag")).distinct()
    return index.expand_suffixes(t("orders").selectExpr("o_orderkey", "concat(o_custkey % 50, '.', o_orderkey % 7) tag"), idx).select("o_orderkey", "tag", "expanded")


@query("""with a as (select p_partkey k, p_name v from part where p_partkey % 3 = 0), b as (select p_partkey k, p_brand v from part where p_partkey % 2 = 0) select coalesce(a.k, b.k) k, case when a.k is not null then a.v else b.v end v, a.k is not null from_first from a full join b on a.k = b.k""")
def index_priority_merge(t):
    p = t("part")
    return index.priority_merge(p.where("p_partkey % 3 = 0").selectExpr("p_partkey k", "p_name v"), p.where("p_partkey % 2 = 0").selectExpr("p_partkey k", "p_brand v"), "k", "v")


@query("select p_partkey % 1500 tag, arg_min(p_brand, p_partkey) brand from part group by 1 having count(distinct p_brand) = 1")
def ambiguous_tags(t):
    return index.unambiguous(t("part").selectExpr("p_partkey % 1500 tag", "p_brand brand", "p_partkey o"), "tag", "brand", "o").select("tag", "brand")


GRAPH = "e as (select distinct o_custkey % 500 src, o_orderkey % 500 dst from orders where o_custkey % 500 <> o_orderkey % 500)"


def graph(t):
    return t("orders").where("o_custkey % 500 <> o_orderkey % 500").selectExpr("o_custkey % 500 src", "o_orderkey % 500 dst").distinct()


@query(f"with recursive {GRAPH}, c as (select distinct src root, src node, 0 depth from e union select c.root, e.dst, c.depth + 1 from c join e on e.src = c.node where c.depth < 5) select root, node, cast(min(depth) as integer) depth from c group by root, node")
def ref_closure(t):
    e = graph(t)
    return index.closure(e, e.selectExpr("src root", "src node").distinct(), 5)


@query(f"with recursive {GRAPH}, c as (select src root, dst node from e union select c.root, e.dst from c join e on e.src = c.node) select distinct root from c where root = node")
def ref_cycles(t):
    e = graph(t)
    return index.closure(e, e.selectExpr("src root", "dst node").distinct(), None).where("root = node").select("root").distinct()


# Sets


@query(f"""with {LINES}, k as (select doc_id, line_no, regexp_replace(line, '^\\s+|\\s+$', '', 'g') k from l where doc_id % 2 = 0), n as (select *, row_number() over (partition by k order by doc_id, line_no) n from k)
select doc_id, line_no from n where n = 1 and k not in (select regexp_replace(line, '^\\s+|\\s+$', '', 'g') from l where doc_id % 2 = 1)""")
def block_merge_dedupe(t):
    table = lines.line_table(t("documents"))
    return merge.new_blocks(table.where("doc_id % 2 = 0"), table.where("doc_id % 2 = 1"), "line", ["doc_id", "line_no"]).select("doc_id", "line_no")


@query("select text, min(doc_id) doc_id, cast(count(*) as bigint) copies from documents group by text")
def exact_dedupe(t):
    return t("documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(rf"with {LINES}, b as (select distinct trim(unnest(string_split(text, chr(10)))) k from benchmark) select doc_id, line_no from l where trim(line) in (select k from b where k <> '')")
def line_semi_join(t):
    keys = lines.line_table(t("benchmark"), "item_id").select(F.trim("line").alias("k")).where("k <> ''").distinct()
    return lines.line_table(t("documents")).withColumn("k", F.trim("line")).join(keys, "k", "left_semi").select("doc_id", "line_no")


@query()
def prefix_fanout(t):
    rows = part_rows(t)
    return records.prefix_fanout(records.mismatches(rows), rows.select(R.source_idx(F.col("exercise"), F.col("part")).alias("source_idx")).distinct())


# Classification and composition

TYPE = rf"""case when regexp_matches(s, '{R.VALUE_WORDS}') then '{R.VALUE}' when regexp_matches(s, '{R.PROOF_WORDS}') then '{R.PROOF}' else '{R.OTHER}' end"""


@query(rf"with d as (select doc_id, regexp_replace(regexp_replace(lower(text), '\\[a-z]+', ' ', 'g'), '\s+', ' ', 'g') s from documents) select doc_id, {TYPE} kind from d")
def problem_type(t):
    return t("documents").select("doc_id", R.problem_type("text").alias("kind"))


@query(rf"""with d as (select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') s from documents), a as (select doc_id, s, regexp_extract_all(s, '(?im)(?:therefore|thus|hence|so)(?:[^\pL\pN_\n][^\n]*)?$') c, list_filter(list_transform(string_split(s, chr(10)), lambda x: trim(x)), lambda x: x <> '') n from d)
select doc_id, case when s = '' then '' else '\[' || chr(10) || coalesce(trim(c[-1]), left(n[-1], 300)) || chr(10) || '\]' end answer from a""")
def direct_answer(t):
    plain = F.regexp_replace("text", r"\\\[", "(")
    return t("documents").select("doc_id", R.direct_answer(F.lit(R.VALUE), plain).alias("answer"))


@query("""select o_orderkey, 'Reference formula (' || o_custkey || '): x = ' || o_orderkey || '. Problem: order ' || o_orderkey text from orders""")
def compose_context(t):
    one = F.array(F.struct(F.concat(F.lit("("), "o_custkey", F.lit(")")).alias("display"), F.concat(F.lit("x = "), "o_orderkey").alias("content")))
    none = F.array().cast("array<struct<display:string,content:string>>")
    return t("orders").select("o_orderkey", R.with_context(F.concat(F.lit("order "), "o_orderkey"), one, none).alias("text"))


@query(f"with {SLOTS} select distinct exercise, part, 'Exercise ' || exercise || case when part <> '' then '-(' || part || ')' else '' end source_idx from s")
def source_idx_roundtrip(t):
    s = slots(t).select(R.source_idx(F.col("exercise"), F.col("part")).alias("source_idx")).distinct()
    return s.select(R.parse_source_idx("source_idx").alias("p"), "source_idx").select("p.exercise", "p.part", "source_idx")


@query("select l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(['theorem:' || (l_partkey % 9), 'lemma:' || (l_suppkey % 9)])), ';') refs from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem)")
def statement_refs(t):
    s = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    return s.select("l_orderkey", "l_linenumber", F.array_join(F.array_sort(R.statement_refs(F.expr("concat('By Theorem ', l_partkey % 9, ' and Lem. ', l_suppkey % 9, ', see thm ', l_partkey % 9)"))), ";").alias("refs"))


# JSON, cache, status


@query("select event_id, json_extract_string(props, '$.' || json_keys(props)[1]) first_value, cast(len(json_keys(props)) as integer) n from events")
def json_extract(t):
    keys = F.json_object_keys("props")
    return t("events").select("event_id", F.element_at(F.from_json("props", "map<string,string>"), F.element_at(keys, 1)).alias("first_value"), F.size(keys).alias("n"))


@query("select sha256('m' || chr(10) || '64' || chr(10) || text) as key, min(doc_id) doc_id from documents where text not in (select text from documents where doc_id % 3 = 0) group by 1")
def cache_lookup(t):
    rows = t("documents").select("doc_id", F.col("text").alias("prompt"), enrich.cache_key("m", "text", 64).alias("key"))
    hits, _ = enrich.cache_lookup(rows, rows.where("doc_id % 3 = 0").select("key", F.lit("x").alias("response")))
    return hits.where("response is null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))


FALL = "f as (select source, case when doc_id % 4 = 0 then '' else text end c, case when doc_id % 8 = 0 then '' else text end p from documents)"


def fallen(t):
    return enrich.fallback(t("documents").select("doc_id", "source", F.expr("case when doc_id % 4 = 0 then '' else text end").alias("problem_with_context"), F.expr("case when doc_id % 8 = 0 then '' else text end").alias("problem")))


@query(r"select doc_id, case when doc_id % 4 > 0 and regexp_matches(text, '\S') then 'fallback_context' when doc_id % 8 > 0 and regexp_matches(text, '\S') then 'fallback_original' else 'failed' end naturalize_status from documents")
def naturalize_fallback(t):
    return fallen(t).select("doc_id", "naturalize_status")


@query(rf"with {FALL} select source, cast(count(*) as bigint) as rows, 0::bigint ok, cast(count_if(regexp_matches(c, '\S') or regexp_matches(p, '\S')) as bigint) fallback, 0::bigint skipped, cast(count_if(not regexp_matches(c, '\S') and not regexp_matches(p, '\S')) as bigint) failed from f group by source")
def status_counts(t):
    return enrich.status_counts(fallen(t), ["source"])


# LaTeX and plans


@query()
def heal_latex(t):
    tex = t("lineitem").select("l_orderkey", "l_linenumber", F.expr(r"concat('Let $x_', l_partkey, ' and \\[ a \\begin{aligned} b & c ', case when l_returnflag = 'R' then '\\end{aligned} \\]' else '' end)").alias("s"))
    return tex.select("l_orderkey", "l_linenumber", latex.heal("s").alias("healed"))


@query()
def placeholder_roundtrip(t):
    tex = t("documents").select("doc_id", F.concat(F.lit("$$a$$ "), "text", F.lit(r" \[b\]")).alias("s"))
    return tex.select("doc_id", latex.placeholder_roundtrip("s").alias("same"))


@query()
def book_records(t):
    return book.book_records(lines.assemble(markup(t), "doc_id", "line_no", "line"))
