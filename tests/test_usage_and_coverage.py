"""Usage trees (S6, A5, A6) and coverage matching."""

from pyspark.sql import functions as F

from benchtrail.operators import coverage as V
from benchtrail.operators import usage as U
from conftest import lines_df

TREE = """root proc (entered 1 times)
    add  2.5  10
    mul  1  4
    add  3  12
    TOTAL  1  16
  hl_fir op (entered 3 times)
      mac  1  9
      TOTAL  1  9
    hl_inner op (entered 2 times)
  hl_fir op (entered 7 times)
      ignored  1  100
      TOTAL  1  100
  hl_iir op (entered 5 times)
      sub  1  2
  hl_fir op (entered 4 times)
root proc (entered 1 times)"""


def test_usage_tree_structure(spark):
    nodes, details = U.parse_usage_tree(lines_df(spark, {"count.log": TREE}))
    n = {r.node_id: r for r in nodes.collect()}
    # ids count every header (closing ones included), so they have gaps
    assert sorted(n) == [0, 1, 2, 4, 5]
    assert (n[0].name, n[0].parent_id, n[0].depth_id) == ("root", None, 0)
    assert (n[1].name, n[1].parent_id, n[1].depth_id, n[1].loop_times) == ("hl_fir", 0, 1, 3)
    assert (n[2].name, n[2].parent_id, n[2].depth_id) == ("hl_inner", 1, 2)
    # after the closing header of hl_fir (id 3) the next header is its sibling
    assert (n[4].name, n[4].parent_id) == ("hl_iir", 0)
    assert n[5].orphan is False and n[5].name == "hl_fir"                 # sibling of hl_iir, same name again
    # the closing "root" header finds the root node (no orphan row)
    assert not any(r.orphan for r in n.values())
    # low usage only where a TOTAL line closed the block
    assert n[0].low_total == 16.0 and n[1].low_total == 9.0 and n[4].low_total is None
    d = {(r.node_id, r.api): (r.average, r.total) for r in details.collect()}
    assert d == {(0, "add"): (3.0, 12), (0, "mul"): (1.0, 4), (1, "mac"): (1.0, 9)}   # last "add" wins


def test_usage_tree_orphan_closing_header(spark):
    text = "a proc (entered 1 times)\n  b op (entered 1 times)\nzz proc (entered 1 times)"
    nodes, _ = U.parse_usage_tree(lines_df(spark, {"o.log": text}))
    orphans = [r for r in nodes.collect() if r.orphan]
    assert len(orphans) == 1 and orphans[0].name == "zz"


def test_high_usage_sum_and_last_name(spark):
    nodes, _ = U.parse_usage_tree(lines_df(spark, {"count.log": TREE}))
    summary, det = U.high_usage(nodes, "hl_")
    s = {r.node_id: r.high_total for r in summary.collect()}
    # children of root: hl_fir(3), hl_iir(5), hl_fir(4): sum counts both hl_fir, the detail keeps the later one
    assert s == {0: 12, 1: 2}
    d = {(r.node_id, r.api): r.total for r in det.collect()}
    assert d[(0, "fir")] == 4 and d[(0, "iir")] == 5 and d[(1, "inner")] == 2


def test_token_match_boundaries(spark):
    apis = spark.createDataFrame([(a,) for a in ["add", "dd", "_x", "mul", "sub", "div", "neg", "abs", "q_r", "r"]], "api string")
    report = lines_df(spark, {"r.html": "\n".join([
        '<span class="lineCov"> y = xadd(a) + mul |</span>',   # add: suffix after 'x'; mul before ' |'
        '<span class="lineCov">call(sub, 2)</span>',             # sub between '(' and ','
        '<span class="lineNoCov"> div(a)</span>',                # not covered
        '<span class="lineCov"> foo_neg(a)</span>',              # neg preceded by '_' -> no
        'abs(lineCov)',                                          # abs at line start: no preceding char
        '<span class="lineCov"> q_r x_r(</span>',                # q_r whole; r preceded by '_' -> no
    ])})
    got = {r.api for r in V.token_match(apis, report).collect()}
    assert got == {"add", "dd", "mul", "sub", "q_r"}


def test_macro_defined_and_list_diff(spark):
    apis = spark.createDataFrame([("FOO",), ("BAR",), ("BAZ",), ("QUX",)], "api string")
    hdr = lines_df(spark, {"h": "#define FOO(x) x\n#define  BAR 1\n#define BAZ_2 3\n# define QUX 1"})
    assert {r.api for r in V.macro_defined(apis, hdr).collect()} == {"FOO", "BAR"}
    cur = spark.createDataFrame([("a",), ("b",)], "api string")
    ref = spark.createDataFrame([("b",), ("c",)], "api string")
    assert {(r.api, r.change) for r in V.list_diff(cur, ref).collect()} == {("a", "added"), ("c", "removed")}
    assert V.list_diff(cur, cur).count() == 0


def test_chain_counts_non_increasing(spark):
    uni = spark.createDataFrame([(f"op_{i}",) for i in range(10)], "api string")
    trace = spark.createDataFrame([("op_0", 2), ("op_1", 0)], "api string, hits bigint")
    report = lines_df(spark, {"r": "lineCov op_2(x)\nlineNoCov op_3(x)"})
    hdr = lines_df(spark, {"h": "#define op_3 1\n#define op_2(x) x"})
    dep = spark.createDataFrame([("op_4",), ("op_0",)], "api string")
    chain = {r.api: r.reason for r in V.coverage_chain(uni, trace, report, hdr, dep).collect()}
    assert chain["op_0"] == "executed" and chain["op_1"] == "not_covered" and chain["op_2"] == "called_macro"
    assert chain["op_3"] == "macro" and chain["op_4"] == "deprecated"
    c = V.chain_counts(V.coverage_chain(uni, trace, report, hdr, dep)).first()
    steps = [c.n_universe, c.n_not_executed, c.n_after_called_macro, c.n_after_macro, c.n_not_covered]
    assert steps == sorted(steps, reverse=True) and steps == [10, 9, 8, 7, 6]


def header(indent, name, times=1):
    return " " * indent + f"{name} op (entered {times} times)"


def relations(spark, *logs):
    lines = lines_df(spark, {f"f{i}": "\n".join(header(*h) for h in log) for i, log in enumerate(logs)})
    nodes, _ = U.parse_usage_tree(lines)
    out = [{} for _ in logs]
    for r in nodes.collect():
        out[int(r.file[1:])][r.node_id] = "orphan" if r.orphan else (r.name, r.parent_id, r.depth_id)
    return out


def test_usage_relations_of_irregular_logs(spark):
    deep = [(0, "a"), (2, "b"), (4, "c"), (6, "d"), (4, "c"), (4, "e"), (2, "b"), (2, "f"), (0, "a")]
    orphan = [(0, "a"), (4, "b"), (2, "x"), (4, "c"), (6, "d")]
    # the closing "b" stands one column off: the open node is b again (indent 4), so "c" at 3 closes too, without a node of its name
    odd = [(0, "a"), (4, "b"), (6, "c0"), (3, "b"), (3, "c"), (4, "d"), (5, "e")]
    # of two nodes of one name the one opened last comes back
    twice = [(0, "a"), (2, "b"), (2, "b"), (4, "c"), (2, "b"), (3, "d"), (2, "b"), (2, "e")]
    # every closing header returns to a deeper node than its own indent says
    chain = [(0, "r")] + [(2 * i, f"n{i}") for i in range(1, 30)] + [(1, f"n{i}") for i in range(29, 0, -1)] + [(2, "last")]
    got = relations(spark, deep, orphan, odd, twice, chain, [], [(3, "only")])
    assert got[0] == {0: ("a", None, 0), 1: ("b", 0, 1), 2: ("c", 1, 2), 3: ("d", 2, 3), 5: ("e", 1, 2), 7: ("f", 0, 1)}
    assert got[1] == {0: ("a", None, 0), 1: ("b", 0, 1), 2: "orphan", 3: ("c", 0, 1), 4: ("d", 3, 2)}
    assert got[2] == {0: ("a", None, 0), 1: ("b", 0, 1), 2: ("c0", 1, 3), 4: "orphan", 5: ("d", 0, 1), 6: ("e", 5, 2)}
    assert got[3] == {0: ("a", None, 0), 1: ("b", 0, 1), 2: ("b", 0, 1), 3: ("c", 2, 3), 5: ("d", 2, 2), 7: ("e", 0, 1)}
    assert got[4][30 - 1] == ("n29", 28, 29) and got[4][59] == ("last", 0, 1) and len(got[4]) == 31
    assert got[5] == {} and got[6] == {0: ("only", None, 0)}


def test_token_match_of_names_of_any_characters(spark):
    names = ["foo", "ns::fn", "a$b", "x-y", "operator+", "dith", "+", "arg::one", "start", "a.b"]
    lines = ["lineCov z foo(1)", "lineCov q=ns::fn(x)", "lineCov t a$b|", "lineCov x-y", "lineCov operator+ 1", "lineCov e_dith(2)", "lineCov f(arg::one, 2)",
             "start lineCov", "lineCov axb "]
    apis = spark.createDataFrame([(n,) for n in names], "api string")
    report = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.api for r in V.token_match(apis, report).collect()}
    assert got == {"foo", "ns::fn", "a$b", "x-y", "operator+", "arg::one", "+"}   # "+" ends "operator+"


def nested(log, prefix="hl_"):
    """One log's tree, read line by line: the roots as dicts."""
    import re
    roots, opened, node, ident, closing = [], [], None, 0, False
    for line in log.split("\n"):
        head = re.match(r"^(\s*)(\S+)\s(\S+)\s\(entered\s(\d+)\stimes\)", line)
        detail = re.match(r"^\s+(\S+)\s+([0-9]+\.?[0-9]*)\s+([0-9]+\.?[0-9]*)", line)
        if head:
            indent, closing = len(head[1]), False
            new = {"name": head[2], "id": ident, "loop_times": int(head[4]), "low_usage": None, "indent": indent, "child_node": [], "up": None, "low": {}}
            if node is not None and indent < node["indent"]:
                node = next((n for n in reversed(opened) if n["name"] == head[2]), node)
                closing = True
            else:
                new["up"] = node if node is not None and indent > node["indent"] else node and node["up"]
                (new["up"]["child_node"] if new["up"] else roots).append(new)
                opened.append(new)
                node = new
            ident += 1
        elif detail and not closing and node is not None:
            if detail[1] == "TOTAL":
                node["low_usage"] = {"summary": {"average": float(detail[2]), "total": float(detail[3])}, "details": node["low"]}
            else:
                node["low"][detail[1]] = {"average": float(detail[2]), "total": int(float(detail[3]))}
    ranks = {x: i for i, x in enumerate(sorted({n["indent"] for n in opened}))}

    def shape(n):
        high = {c["name"][len(prefix):]: {"average": None, "total": c["loop_times"]} for c in n["child_node"] if c["name"].startswith(prefix)}
        total = sum(c["loop_times"] for c in n["child_node"] if c["name"].startswith(prefix))
        out = {"name": n["name"], "id": n["id"], "loop_times": n["loop_times"], "low_usage": n["low_usage"],
               "high_usage": {"summary": {"average": None, "total": total}, "details": high} if total else None, "pid": ranks[n["indent"]], "changelist": 7}
        return out | ({"child_node": [shape(c) for c in n["child_node"]]} if n["child_node"] else {})
    return [shape(r) for r in roots]


def test_nested_trees_equal_a_reading_line_by_line(spark):
    import json
    import random
    logs = {}
    for seed in range(6):
        r, lines, stack = random.Random(seed), [], []
        for i in range(40):
            step = r.random()
            if stack and step < 0.25:
                stack = stack[:r.randint(1, len(stack))]
                lines.append(header(stack[-1][0], stack[-1][1], 99))  # back to an open node
            else:
                indent = (stack[-1][0] + r.choice([0, 2, 2, 4])) if stack else 0
                while stack and stack[-1][0] >= indent:
                    stack.pop()
                stack.append((indent, r.choice(["hl_", "n_", 'q"\\']) + str(i)))
                lines.append(header(*stack[-1], r.randint(0, 3)))
            if r.random() < 0.5:
                lines += [f"   api_{r.randint(0, 2)} 1.5 {r.randint(1, 9)}", "   api_z 2 3.0"] + ["   TOTAL 3.5 12"] * r.randint(0, 1)
        logs[f"f{seed}"] = "\n".join(lines)
    nodes, details = U.parse_usage_tree(lines_df(spark, logs))
    got = {}
    for r in U.usage_trees(nodes, details, "hl_", F.lit(7)).orderBy("file", "node_id").collect():
        got.setdefault(r.file, []).append(json.loads(r.tree))
    assert got == {f: nested(log) for f, log in logs.items()}
    none = U.usage_trees(nodes.limit(0), details.limit(0), "hl_", F.lit(7))
    assert none.count() == 0 and none.columns == ["file", "node_id", "tree"]


def test_long_chains_of_parents_settle_in_few_stored_tables(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(U, "materialize", lambda df, name, store=U.materialize: stored.append(name) or store(df, name))
    n = 3000  # one root and its children, each as the one before; every 50th is a level deeper, under it
    text = ["root op (entered 1 times)"] + [x for i in range(n) for x in [f"  a{i} op (entered 1 times)", *([f"    b{i} op (entered 1 times)", f"  a{i} op (entered 1 times)"] if i % 50 == 0 else [])]]
    lines = spark.createDataFrame([("f", i + 1, x) for i, x in enumerate(text)], "file string, line_no bigint, line string")
    monkeypatch.setattr(U, "DEFAULT_CHUNK", 64, raising=False)
    nodes, _ = U.parse_usage_tree(lines)
    got = {r.name: (r.node_id, r.parent_id) for r in nodes.collect()}
    assert len(got) == 1 + n + n // 50
    assert all(got[f"a{i}"][1] == 0 for i in range(n)) and all(got[f"b{i}"][1] == got[f"a{i}"][0] for i in range(0, n, 50))
    assert stored.count("parents") <= 12 - 4, stored  # doubling over all nodes took 13


def test_parents_across_chunks(spark):
    rows = [("f", 1, None, None), *[("f", i, 1, None) if i % 997 == 2 else ("f", i, None, i - 1 if i % 3 else max(2, i - 40)) for i in range(2, 2500)]]
    want = {1: None}
    for _, i, parent, same in rows[1:]:
        want[i] = parent if same is None else want[same]
    state = spark.createDataFrame(rows, "file string, line_no bigint, parent bigint, same_as bigint")
    assert {r.line_no: r.parent for r in U.resolve_parents(state, chunk=50).collect()} == want
