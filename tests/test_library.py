"""Hand-written cases of the functions and operators."""

import bisect
import importlib
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from scriptorium import queries
from scriptorium.functions import latex
from scriptorium.functions import pages as P
from scriptorium.functions import records as R
from scriptorium.functions import text as T
from scriptorium.operators import enrich, index, lines, merge, records, segment

DATA = "/root/testdata/sf0.001"


def one(spark, column, s, *more):
    return spark.createDataFrame([(s, *more)], "s string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("line, want", [
    ("2.10 Foo", "**Exercise 2.10** Foo"), ("### 2.1 Bar", "**Exercise 2.1** Bar"), ("**2.10 Set** tail", "**Exercise 2.10** Set tail"),
    ("0.949 x_1", "**Exercise 0.949** x_1"), ("10 apples", "10 apples"),
])
def test_headers(spark, line, want):
    assert one(spark, T.exercise_header(F.col("s")), line) == want


@pytest.mark.parametrize("s, want", [("Show that the minimum exists.", R.VALUE), (r"Prove that $\max f$ is convex.", R.PROOF), ("Discuss.", R.OTHER)])
def test_problem_type(spark, s, want):
    assert one(spark, R.problem_type("s"), s) == want


def test_text_rules(spark):
    long, short = "a line that is long enough", "a line that is 23 chars"
    assert one(spark, T.squash_repeats("s"), "\n".join([long] * 4 + [short] * 4)).split("\n") == [long] * 2 + [short] * 4
    assert one(spark, T.has_heavy_repetition("s"), "\n".join([long] * 11)) is False
    assert one(spark, T.has_heavy_repetition("s"), "\n".join([long] * 3 + [f"x{k}" for k in range(9)])) is True
    assert one(spark, T.has_heavy_repetition("s"), "\n".join([long] * 2 + [f"x{k}" for k in range(10)])) is False
    assert one(spark, T.has_runaway_list("s"), " ".join(f"{k}." for k in range(5000))) is True
    assert one(spark, T.bracket_errors("s"), "(a[b)]") == 2
    assert one(spark, T.split_solution_boundaries("s"), "(b) x Solution. y") == "(b) x\nSolution. y"
    assert one(spark, R.range_refs("s"), "(18.50b)--(18.50d)") == ["18.50b", "18.50c", "18.50d"]
    assert one(spark, R.bare_refs("s"), "See (11.1) and sin(5x)") == ["11.1", "5x"]
    assert one(spark, T.sanitize("s"), None) == ""


def test_pages_and_order(spark):
    docs = spark.createDataFrame([(1, "junk\n<!-- PAGE 2 -->\nA\n<!-- PAGE 3 -->\n B "), (2, " x ")], "doc_id long, text string")
    assert {tuple(r) for r in segment.split_pages(docs, "doc_id", "text").collect()} == {(1, 2, "A"), (1, 3, "B"), (2, 1, "x")}
    ids = [("2.10", ""), ("2.9", ""), ("2.9", "b"), ("2.9", "a"), ("2.9", "ii"), ("UNKNOWN", "")]
    rows = records.reindex(spark.createDataFrame(ids, "exercise string, part string")).orderBy("index").collect()
    assert [(r.exercise, r.part) for r in rows] == [("2.9", "a"), ("2.9", "b"), ("2.9", "ii"), ("2.9", ""), ("2.10", ""), ("UNKNOWN", "")]


def test_blocks(spark):
    table = lines.line_table(spark.createDataFrame([(1, '%<BLOCK type=thm label="E">\nx\n%</BLOCK>\n%<BLOCK type=thm label="F">\ny')], "doc_id long, text string"))
    assert segment.top_blocks(table).count() == 2 and segment.top_blocks(table, unclosed=False).count() == 1
    blocks = segment.sessionize(lines.line_table(spark.createDataFrame([(1, "intro\nExercise 1.1 Do it.\nSolution. Done.\nSolution. Again.")], "doc_id long, text string")))
    assert [(r.kind, r.md) for r in blocks.orderBy("ord").collect()] == [("para", "intro"), ("exercise", "Exercise 1.1\nDo it."), ("proof", "Solution.\nDone.\nSolution.\nAgain.")]


def test_validate(spark):
    rows = spark.createDataFrame([(1, "Exercise 1.1-(a)", "p", "q", ["其他"]), (2, "Exercise 1.1-(b)", "p", "", ["其他"]), (3, "Exercise 1.1", "p", "", ["x"])], "index int, source_idx string, problem string, proof string, `题目类型` array<string>")
    got = {(r.type, r.source_idx or r.exercise) for r in records.validate(rows).collect()}
    assert got == {("missing_proof", "Exercise 1.1-(b)"), ("invalid_problem_type", "Exercise 1.1"), ("subpart_mismatch", "1.1")}


def test_latex():
    assert latex.heal_text("$$a$$") == "\\[\na\n\\]"
    for s in (r"\[ a", r"a \]", r"\( x", r"\begin{align} a", r"a \end{align} b"):
        once = latex.heal_text(s)
        assert latex.heal_text(once) == once and once.count(r"\[") == once.count(r"\]")
    hidden, blocks = latex.hide_math("a $$x$$ b \\[y\\]")
    assert latex.show_math(hidden, blocks) == "a $$x$$ b \\[y\\]" and latex.same_placeholders(hidden, hidden)
    assert latex.keep_tags(r"\tag{1}\tag{1}\tag{2}", ["1"]) == r"\tag{1}"


def test_merge_and_cache(spark):
    end = "\\begin{document}\nold\n\\end{document}\n"
    blocks = spark.createDataFrame([(1, 1, "new"), (1, 2, "new "), (1, 3, "old")], "doc_id long, ord int, raw string")
    kept = merge.new_blocks(blocks, spark.createDataFrame([(1, "old")], "doc_id long, raw string"), "raw", ["ord"], ["doc_id"])
    r = merge.merge_documents(blocks, spark.createDataFrame([(1, end)], "doc_id long, text string"), kept, marker=False).first()
    assert (r.text, r.kept, r.skipped) == ("\\begin{document}\nold\n\nnew\n\n\\end{document}\n", 1, 2)
    rows = spark.createDataFrame([("a",), ("b",)], "prompt string").withColumn("key", enrich.cache_key("m", "prompt", 5))
    _, missing = enrich.cache_lookup(rows, rows.where("prompt = 'a'").select("key", F.lit("r").alias("response")))
    assert [r.response for r in enrich.complete(missing, enrich.EchoClient(), "m", 5).collect()] == ["b"]
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    assert index.closure(e, spark.createDataFrame([(1, 1)], "root long, node long"), 5).count() == 3


@pytest.mark.parametrize("name", ["line_repetition", "quality_score", "block_sessionize", "validate_records", "suffix_expand", "exact_dedupe", "coverage_sets", "ref_closure", "ref_cycles", "page_split", "title_and_task_lines"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "lineitem", "orders", "part", "conversations"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols and sorted(map(repr, got[cols].values.tolist())) == sorted(map(repr, want[cols].values.tolist()))


def test_pages_complete(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{DATA}/conversations.parquet'")
    assert whole(spark, "doc_complete") == sorted(con.sql(queries.ORACLE_SQL["doc_complete"]).fetchall())
    for s, pages, want in [
        ("<!--  PAGE  2-->\nA\n\n <!--PAGE 3 --> \nB", 3, True), ("<!--  PAGE  2-->\nA\n\n <!--PAGE 3 --> \nB", 4, False), ("<!-- PAGE 2 -->\nsee <!-- PAGE 9 --> there", 3, False),
        ("<!-- PAGE 1 -->\n\n<!-- PAGE 2 -->", 2, True), ("<!-- PAGE 99999999999999999999 -->", 3, True), ("no mark", 3, True), ("<!-- PAGE 1 -->", None, True), ("", None, False), (None, 1, False),
    ]:
        assert one(spark, T.pages_complete("s", F.lit(pages).cast("long")), s) is want


def whole(spark, name):
    return sorted(map(tuple, queries.QUERIES[name](spark, DATA).collect()))


def test_all_parts(spark):
    parts = {}
    for r in queries.slots(lambda t: spark.read.parquet(f"{DATA}/{t}.parquet")).where("part <> ''").collect():
        parts.setdefault(f"{r.doc_id}:{r.exercise}", ([], []))[r.field == "proof"].append(r.part)
    sets = {k: (sorted(set(a)), sorted(set(b))) for k, (a, b) in parts.items()}
    assert whole(spark, "coverage_sets") == sorted((k, ",".join(a), ",".join(b), ",".join(x for x in a if x not in b)) for k, (a, b) in sets.items())
    ids = {k: {f"Exercise {k}-({x})" for x in a + b} for k, (a, b) in sets.items()}
    every = sorted(set().union(*ids.values()))
    starts = lambda p: every[bisect.bisect_left(every, p) : bisect.bisect_left(every, p + "\uffff")]
    assert whole(spark, "prefix_fanout") == sorted((k, x) for k, (a, b) in sets.items() if a != b for x in starts(f"Exercise {k}"))


def test_all_references(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey", "o_custkey").collect()
    out = {}
    for r in orders:
        if r.o_custkey % 500 != r.o_orderkey % 500:
            out.setdefault(r.o_custkey % 500, set()).add(r.o_orderkey % 500)
    want, cyclic = [], []
    for root in out:
        depth, front, k = {root: 0}, [root], 0
        while front:
            k, front = k + 1, [y for x in front for y in out.get(x, ())]
            if root in front and (root,) not in cyclic:
                cyclic.append((root,))
            front = [y for y in dict.fromkeys(front) if y not in depth]
            depth |= dict.fromkeys(front, k)
        want += [(root, x, d) for x, d in depth.items() if d <= 5]
    assert whole(spark, "ref_closure") == sorted(want) and whole(spark, "ref_cycles") == sorted(cyclic)
    part = spark.read.parquet(f"{DATA}/part.parquet").select("p_partkey", "p_size").collect()
    tags = {f"{r.p_partkey % 50}.{r.p_size % 7}{'abc'[r.p_size % 3]}" for r in part} | {f"{r.p_partkey % 50}.1" for r in part if r.p_partkey % 2 == 0}
    refs = [(r.o_orderkey, f"{r.o_custkey % 50}.{r.o_orderkey % 7}") for r in orders]
    assert whole(spark, "suffix_expand") == sorted((k, t, t + c) for k, t in refs if t not in tags for c in "abc" if t + c in tags)


def test_long_cycle(spark):
    e = spark.createDataFrame([(k, (k + 1) % 8) for k in range(8)] + [(9, 0)], "src long, dst long")
    got = index.closure(e, e.selectExpr("src root", "dst node"), None).where("root = node").select("root").distinct()
    assert sorted(r.root for r in got.collect()) == list(range(8))


def test_entry_without_llm():
    assert importlib.import_module("__spark_entry__").queries()


def test_one_evaluation(spark):
    """Values that rules mention often are evaluated once, so long texts of many lines, and blank ones, end."""
    blank = spark.createDataFrame([(" \n\t\n",), ("",), (None,), ("x\n" * 300,)], "s string")
    assert [r.x for r in blank.select(T.interleaved_columns("s").alias("x")).collect()] == [False, False, False, True]
    began = time.time()
    assert one(spark, P.pathological("s"), "\n".join(f"line {k} of {k * k}" for k in range(20000))) is False and time.time() - began < 30
    assert one(spark, P.pathological("s"), " ".join(f"{k}." for k in range(5000))) is True
    for c, s, want in [
        (T.has_heavy_repetition("s"), "\n".join([f"a line  that is{b}long enough" for b in " \t\xa0"] + [f"x{k}" for k in range(9)]), True),
        (T.english_ok("s"), "it's one two three four five", True), (T.english_ok("s"), "a'b c d e f", False), (T.english_ok("s"), "één twee één öö ää üü", False), (T.english_ok("s"), "één two three four five six", True),
        (P.running_headers("s")["removed"], "text", 0), (P.running_headers("s")["removed"], "x\n CHAPTER 3 \ny", 1),
    ]:
        assert one(spark, c, s) == want, s


def test_phrase_repeats():
    r = random.Random(3)
    pattern, found = re.compile("([^\n\r\x85  ]{20,80})\\1{4}"), 0
    for k in range(300):
        phrase = "".join(r.choices("ab ", k=r.randint(18, 84)))
        s = "".join(r.choices("abcd", k=r.choice([0, 50] * 8 + [15900, 16300]))) + (phrase * 6)[: r.randint(len(phrase) * 4, len(phrase) * 6)] + "".join(r.choices("ab", k=r.randint(0, 99)))
        if k % 5 == 0:
            s = s[:-150] + "\n" + s[-150:]
        found += (want := bool(pattern.search(s)))
        assert P.phrase_repeats(s) == want
    assert 20 < found < 280


def test_prefix_keys(spark):
    """Prefixes that end as no name does aren't joined; all matches are found."""
    names = spark.createDataFrame([("7:2.1",), ("7:3.4",)], "exercise string")
    rows = spark.createDataFrame([("Exercise 7:2.10-(a)",), ("Exercise 7:2.1",), ("Exercise 7:3.4",), ("Exercise 8:3.4",), ("Exercise",), (None,)], "source_idx string")
    out = records.prefix_fanout(names, rows)
    assert sorted(map(tuple, out.collect())) == [("7:2.1", "Exercise 7:2.1"), ("7:2.1", "Exercise 7:2.10-(a)"), ("7:3.4", "Exercise 7:3.4")]
    assert records.prefix_fanout(names.where("exercise is null"), rows).count() == 0
    assert "array_contains" in out._jdf.queryExecution().optimizedPlan().toString()


def test_squash_once(spark):
    s, mixed = "a line that is long enough", [(f"line {k} that is long enough") for k in range(4000)]
    began = time.time()
    assert one(spark, T.squash_repeats("s"), "\n".join(mixed)).count("\n") == 3999 and time.time() - began < 20
    assert one(spark, T.squash_repeats("s"), "\n".join([s, s.upper(), s, "x", s, "", s, s, s])).split("\n") == [s, s.upper(), "x", s, "", s, s]
    plan = spark.range(1).select(T.squash_repeats(F.lit(s)).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") < 4
