"""Hand-written cases of page rules and of equation and statement indexes, and SQL for the queries that have it."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from scriptorium import page_queries, queries
from scriptorium.functions import pages as P
from scriptorium.functions import text as T
from scriptorium.operators import assemble as A
from scriptorium.operators import equations as E
from scriptorium.operators import segment
from scriptorium.plans import book

DATA = "/root/testdata/sf0.001"


def one(spark, column, s):
    return spark.createDataFrame([(s,)], "s string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("name", [n for n in vars(page_queries) if n in queries.ORACLE_SQL])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view lineitem as from '{DATA}/lineitem.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).to_arrow_table()
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.column_names)
    cols = sorted(got.columns)
    a, b = sorted(map(repr, got.select(*cols).toPandas().values.tolist())), sorted(map(repr, want.select(cols).to_pandas().values.tolist()))
    assert a and a == b


def test_page_rules(spark):
    x = one(spark, P.running_headers("s"), "## Exercises\ntext p*.Exercises 2.35 Show\n3 Duality\nend")
    assert (x.text, x.removed) == ("text p*. 2.35 Show\nend", 3)
    assert one(spark, P.pathological("s"), "\n".join(["a"] * 8 + [f"l{k}" for k in range(12)])) and not one(spark, P.pathological("s"), "\n".join(["a"] * 7 + [f"l{k}" for k in range(13)]))
    assert one(spark, P.pathological("s"), "ab " * 80) and one(spark, P.reject_reason("s"), "Output only LaTeX") == "prompt_leak"
    assert one(spark, P.page_score("s", F.lit(2), F.lit(True), F.lit(False)), "$$\nx") == 4 - 1500 - 80 - 2500 and one(spark, P.page_score("s", F.lit(0), F.lit(False), F.lit(False)), None) == -1e9
    b = one(spark, T.strip_leading_boilerplate("s", ["head", "(bad", 3], 2), "\nHead 1\n\nhead 2\nhead 3\nbody\n")
    assert (b.text, b.removed) == ("head 3\nbody", 2)
    b = one(spark, T.strip_leading_boilerplate("s", T.DO_NOT_CHANGE, 3), "Do not change the text.\n\n")
    assert (b.text, b.removed) == ("", 1)
    assert one(spark, P.tidy_page("s"), "a\xa0b\n\n\n\n\nc") == "a b\n\n\nc" and one(spark, P.plain_symbols("s"), "§3") == "\\S 3"
    a = one(spark, P.split_answer("s"), "```latex\n<<<PROOF_MD>>> p <<<REST>>>\nr\n```")
    assert a.rest.startswith("r") and a.proof == "p"
    assert one(spark, P.document_body("s"), "a\\begin{document}b\\end{document}c") == "b" and one(spark, P.heading_text("s"), "## T ") == "T"
    assert one(spark, P.similar_enough("s", F.lit("Same  text")), "Same text") and not one(spark, P.similar_enough("s", F.lit("other")), "Same text")
    r = one(spark, P.first_and_rest("s"), "\n a \nb\n")
    assert (r.first, r.rest) == ("a", "b")
    assert one(spark, P.subpart_block(F.lit("subpart_proof"), F.lit("2.1"), F.lit("b"), F.col("s")), " By Lemma 3 ") == '%<BLOCK type=subpart_proof label="Exercise 2.1(b)" exercise="2.1" part="b" refs="lemma:3">\nBy Lemma 3\n%</BLOCK>'
    assert one(spark, P.tex_document("P\n", F.array("s", F.lit(" "))), "x") == "P\nx\n\n\\end{document}\n"


def test_linear(spark):
    long = " " * 10**6 + "x" + " \t" * 10**6
    T_ = [T.strip(F.col("s")), T.rstrip(F.col("s")), T.squeeze(F.col("s"))]
    one(spark, T_[0], "warm")
    for c in T_:
        began = time.time()
        assert one(spark, c, long).strip() == "x" and time.time() - began < 5
    began = time.time()
    assert one(spark, T.bracket_errors("s"), "(" * 10**6) == 10**6 and time.time() - began < 10
    assert one(spark, T.bracket_errors("s"), "([)]}") == 3 and one(spark, T.bracket_errors("s"), None) == 0


def test_tags():
    s = "a \\[ x \\tag{1.1} \\] b \\begin{align} p \\tag{1.2} \\\\ q \\tag{ 1.3 } \\end{align} \\tag{1.1} \\tag{(9)}"
    x = E.tag_index(s)
    assert list(x) == ["1.1", "1.2", "1.3", "9"] and x["1.1"]["position"] == s.index("\\tag") and x["1.1"]["equation"] == "\\[ x \\tag{1.1} \\]"
    assert x["1.3"]["equation"] == "\\begin{align*}\nq \\tag{ 1.3 }\n\\end{align*}" and x["9"]["equation_full"] == ""
    assert E.preview("\\[ \\begin{aligned} a \\\\ b \\end{aligned} \\tag{1} \\tag{2} \\]") == "\\begin{align*}\na \\tag{1} \\\\\nb \\tag{2}\n\\end{align*}"
    assert E.preview("\\[ a \\\\ b \\quad (3.1) \\tag{1} \\tag{2} \\]") == "\\begin{align*}\na \\tag{1} \\\\\nb \\tag{2}\n\\end{align*}"
    assert E.preview("$$ a $$") == "$$ a $$" and len(E.displays("$$ \\[ a \\] $$ \\[ b")) == 2


def test_fallback():
    x = E.fallback_index("$$ a (18.50a) $$ \\[ b \\tag{2.1} (3.3) \\] $$ c (4.1) $$ $$ d （4.1） $$")
    assert list(x) == ["18.50a", "18.50", "2.1"] and x["18.50"]["equation"] == "$$ a (18.50a) $$"


def test_references():
    known = {"1.1": {}, "2.2b": {}, "2.2c": {}, "14.4a": {}}
    refs, by, missing = E.body_refs("See (1.1), Eq. (2.2\\mathrm{c}) and (2.2b)–(2.2d); (14.4), (7).", known, {"14.4": ["14.4a"]})
    assert refs == ["2.2c", "2.2b", "1.1", "14.4a"] and by["2.2c"] == "Eq. (2.2c)" and by["2.2b"] == "(2.2b)-(2.2d)" and missing == ["2.2d", "7"]
    assert E.resolvable("Thm. 3 and (2) and (1) Prop 3", {"1": 0, "2": 0}, {"theorem:3": 0}) == ["2", "1", "theorem:3"]
    s = E.statement_index('%<BLOCK type=origintext label="Lem. 2.1">\nBody\n(1)\n%</BLOCK>\n%<BLOCK label="x" type=origintext>\nAlgorithm 3 runs\n%</BLOCK>\n')
    assert s == {"lemma:2.1": {"display": "Lemma 2.1", "content": "Body (1)"}, "algorithm:3": {"display": "Algorithm 3", "content": "Algorithm 3 runs"}}


def test_expansion():
    eq = lambda s: {"equation": s, "content": ""}
    tags = {"1": eq("one (2)"), "2": eq("two by Lemma 3"), "4": eq("four (1)"), "5": eq("")}
    text, notes = E.expand("use (1), (4), (5)", tags, {"lemma:3": {"display": "Lemma 3", "content": "see (1)"}})
    assert text == "use (1), (4), (5)\n\n[(1): one (2)]\n\n[(4): four (1)]\n\n[(2): two by Lemma 3]\n\n[Lemma 3: see (1)]"
    assert notes == ["double reference + (4)", "Cyclic reference detected: (1) (in expansion of (4))", "third reference + (2)", "fourth reference + Lemma 3", "Cyclic reference detected: (1) (in expansion of Lemma 3)"]
    chain = {str(k): eq(f"({k + 1})") for k in range(12)}
    for most, n in ((0, 1), (1, 3), (2, 7), (5, 12)):  # a level ends with one more look, so its bound allows 2 ** (most + 1) - 1
        assert E.expand("(0)", chain, {}, most)[0].count("[(") == n
    assert E.expand("none", tags, {}) == ("none", []) and E.expand("(1)", tags, {}, insert=lambda t, d, c: "smooth")[0] == "smooth"


def test_numbers():
    assert E.attach_numbers("a\n\\[x\\]\n$$y$$\n\n(6.4)\nb") == "a\n\\[\n\\begin{aligned}\nx \\\\\ny\n\\end{aligned}\n\\tag{6.4}\n\\]b"
    assert E.attach_numbers("\\[x \\tag{1}\\]\n(1)\n") == "\\[x \\tag{1}\\]" and E.attach_numbers("t\n(1)\n") == "t\n(1)\n"
    assert E.bind_numbers("$$\nx\n$$\n\n(1.1)\n\nb\n(2)") == ("$$\nx\n\\tag{1.1}\n$$\n\nb\n(2)", 1)
    assert E.inner_of("\\begin{equation*}\\begin{aligned}a\\end{aligned}\\tag{1}\\end{equation*}") == "a"


def test_null_texts(spark):
    docs = spark.createDataFrame([(1, None), (None, "\\[ x \\tag{1} \\] see (1)"), (3, "")], "doc_id long, text string")
    assert [(r.doc_id, r.tag) for r in E.equation_index(docs).collect()] == [(None, "1")]
    assert sorted((str(r.doc_id), r.refs) for r in E.references(docs).collect()) == [("1", []), ("3", []), ("None", ["1"])]
    assert E.display_blocks(docs.where("false")).count() == 0 and E.expanded(docs).count() == 3


def block(kind, *lines, **attrs):
    return "\n".join([f"%<BLOCK type={kind}" + "".join(f' {k}="{v}"' for k, v in attrs.items()) + ">", *lines, "%</BLOCK>"])


def env(kind, *lines):
    return "\n".join([f"\\begin{{{kind}}}", *lines, f"\\end{{{kind}}}"])


def slots(s):
    return [(e, p, x.problem, x.proof) for e, p, x in A.fold(s).rows()]


def test_blocks():
    assert A.opened('%<BLOCK label="no type">') is None and A.opened(r'  %<BLOCK type=thm label="a \"b\"" part=c>  ').attrs == {"type": "thm", "label": 'a "b"', "part": "c"}
    s = block("thm", "one", block("note", "two", block("subpart_statement", "three")), "four")
    (root,) = A.sentinel_roots(s)
    assert root.body() == "one\nfour" and root.split("note")[0] == "one\nfour" and root.split("subpart_statement") == ("one\ntwo\nfour", [])
    assert A.sentinel_roots("%</BLOCK>\n%<BLOCK type=thm>\nlost") == [] and A.sentinel_roots(block("note", "x")) == []
    (root,) = A.environment_roots(env("thm", env("thm", "Exercise 2.1 in"), block("note", "n"), block("subpart_statement", "s", part="A")))
    assert root.label == "Exercise 2.1" and root.body() == 'Exercise 2.1 in\n%<BLOCK type=note>\nn\n%</BLOCK>' and [x.body() for x in root.items if isinstance(x, A.Node)] == ["s"]
    assert [(x.kind, x.label, x.body()) for x in A.environment_roots("\\begin{proof}\nopen")] == [("proof", "Proof", "open")]


def test_slots():
    part = lambda kind, p, text, **more: block(f"subpart_{kind}", text, part=p, **more)
    many = block("thm", "Stem", part("statement", "B", "sb"), part("statement", "a", "sa"), part("statement", "c", "sc"), label="Exercise 1.2")
    assert slots(many + "\n" + block("proof", "one") + "\n" + block("proof", "two")) == [("1.2", "a", "sa", "two"), ("1.2", "b", "sb", "one"), ("1.2", "c", "sc", "")]
    twice = block("proof", "lead", part("proof", "b", "p1"), part("proof", "b", "p2"), part("proof", "b", "p3"))
    assert slots(many + "\n" + twice) == [("1.2", "a", "sa", "p2"), ("1.2", "b", "sb", "p1"), ("1.2", "c", "sc", "p3")]
    assert slots(many + "\n" + block("proof", "lead", part("proof", "c", "p"))) == [("1.2", "a", "sa", "lead"), ("1.2", "b", "sb", ""), ("1.2", "c", "sc", "p")]
    assert slots(many + "\n" + block("proof", "lead", part("proof", "a", "p"))) == [("1.2", "a", "sa", "p"), ("1.2", "b", "sb", "lead"), ("1.2", "c", "sc", "")]
    named = block("thm", part("statement", "a", "s", exercise="7.1")) + "\n" + block("thm", "plain")  # the number comes from the part, then from the block before
    assert slots(named) == [("7.1", "a", "s", ""), ("7.1", "", "plain", "")]
    assert slots(block("thm", "x")) == [("", "", "x", "")] and slots("") == [] and slots("text") == []
    assert [k[0] for k in slots("\n".join(block("thm", "t", label=f"Exercise {n}") for n in ("2.10", "2.9", "10.1")))] == ["2.9", "2.10", "10.1"]
    three = [env("thm", f"Exercise 5.{k}") + "\n" + env("proof", f"p{k}") for k in range(3)]
    marked = "\n".join(block("thm", env("thm", f"Exercise 5.{k}"), label=f"Exercise 5.{k}") + "\n" + block("proof", env("proof", f"q{k}")) for k in range(2))
    assert [x[3] for x in slots("\n".join(three + [block("thm", "m", label="Exercise 9.1")]))] == ["p0", "p1", "p2"]  # too few sentinels
    assert [(x[0], x[3]) for x in slots(marked + "\n" + three[2])] == [("5.0", "q0"), ("5.1", "q1"), ("5.2", "p2")]  # the one that they lack


def test_tex_records(spark):
    text = block("origintext", "Every x.", label="Lemma 3") + "\n" + r"\[ a = b \tag{1.1} \]" + "\n" + block("thm", "Show it by (1.1) and (1.9).", label="Exercise 4", refs="Lem:3") + "\n" + block("proof", "Done.")
    rows = book.tex_records(spark.createDataFrame([(1, text), (2, None), (None, text), (3, "")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [None, 1]
    r = rows[1]
    assert (r["index"], r.source_idx, r.proof, r.body_refs, r.unresolved, r.theorem_refs, r.direct_answer) == (1, "Exercise 4", "Done.", ["1.1"], ["1.9"], ["lemma:3"], "")
    assert r.problem_with_context.startswith("Reference formula (1.1): ") and "Reference result Lemma 3: Every x.. Problem: Show it" in r.problem_with_context


def test_many_references():
    tags = {str(k): {"equation": f"({(k + 1) % 3000})", "content": ""} for k in range(3000)}
    began = time.time()
    text, _ = E.expand(" ".join(f"({k})" for k in range(3000)) + " plain words" * 2000, tags, {"lemma:1": {"display": "Lemma 1", "content": "x"}})
    assert text.count("[(") == 3000 and time.time() - began < 10


def test_compiled_once(monkeypatch):
    s = "\\[ \\begin{aligned} a \\\\ b \\end{aligned} \\tag{1.1} \\tag{1.2} \\] $$ x (2.1a) $$ \\begin{align} a \\tag{3.1} \\\\ b \\tag{3.2} \\end{align} see (1.1), (2.1)"
    monkeypatch.setattr(E.re, "_compile", lambda *a: pytest.fail("a pattern was looked up"))
    tags, more = E.tag_index(s), E.fallback_index(s)
    refs = E.body_refs(s, more | tags, {})[0]
    monkeypatch.undo()
    assert list(tags) == ["1.1", "1.2", "3.1", "3.2"] and refs == ["2.1a", "1.1", "2.1"] and tags["3.2"]["equation"] == "\\begin{align*}\nb \\tag{3.2}\n\\end{align*}"


def test_attributes_once(spark):
    plan = queries.QUERIES["attrs_map"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    assert one(spark, segment.attributes(F.col("s")), 'a="1=\\"x\\"" b=2 a=3 c="" a=4') == {"b": "2", "a": "4", "c": ""}
