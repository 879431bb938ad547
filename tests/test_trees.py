from tallyloom.operators import trees as T
from tallyloom.schema import NODES


def node(i, parent, ord_, depth, kind, text, named=True, record="r", row=0):
    return (record, i, parent, ord_, depth, kind, named, text, row, row)


def test_level_order_and_metrics(spark):
    df = spark.createDataFrame(
        [node(0, None, 0, 1, "root", "xyz"), node(1, 0, 0, 2, "A", "xy"), node(2, 1, 0, 3, "identifier", "x"),
         node(3, 1, 1, 3, "identifier", "y"), node(4, 0, 1, 2, "identifier", "z"),
         node(0, None, 0, 1, "root", "aa", record="q"), node(1, 0, 0, 2, "identifier", "a", record="q"),
         node(2, 0, 1, 2, "identifier", "a", record="q")], NODES)
    tokens = {r.record_id: r.code_tokens for r in T.leaf_tokens(df).collect()}
    assert tokens == {"r": ["z", "x", "y"], "q": ["a", "a"]}
    assert {r.record_id: r.code_tokens for r in T.leaf_tokens(df, "source").collect()}["r"] == ["x", "y", "z"]
    metrics = {r.record_id: tuple(r)[1:] for r in T.tree_metrics(df).collect()}
    assert metrics == {"r": (5, 3, 3, 3, 3), "q": (3, 2, 1, 1, 2)}


def test_branch_complexity(spark):
    rows = [node(0, None, 0, 1, "program", "code"), node(1, 0, 0, 2, "if_statement", "if")]
    for i, op in ((10, "&&"), (20, "+")):
        rows += [node(i, 0, i, 2, "binary_expression", "e"), node(i + 1, i, 0, 3, "identifier", "a"),
                 node(i + 2, i, 1, 3, op, op), node(i + 3, i, 2, 3, "identifier", "b")]
    # Two children only: the operator does not count.
    rows += [node(30, 0, 30, 2, "binary_expression", "e"), node(31, 30, 0, 3, "identifier", "a"), node(32, 30, 1, 3, "||", "||")]
    rows += [node(40, 0, 40, 2, "switch_label", "case"), node(41, 0, 41, 2, "switch_label", "default")]
    rows += [node(0, None, 0, 1, "program", " \n\t", record="blank")]
    df = spark.createDataFrame(rows, NODES)
    assert {r.record_id: r.cyclomatic_complexity for r in T.branch_complexity(df).collect()} == {"r": 5, "blank": 0}


def test_declarations_and_comments(spark):
    df = spark.createDataFrame(
        [node(0, None, 0, 1, "program", "all"),
         node(1, 0, 0, 2, "block_comment", " /* hi */ \n"),
         node(2, 0, 1, 2, "method_declaration", "void f(int a) {}", row=4),
         node(20, 2, 0, 3, "void_type", "void"), node(21, 2, 1, 3, "identifier", "f"),
         node(22, 2, 2, 3, "formal_parameters", "(int a)"), node(23, 2, 3, 3, "block", "{}"),
         node(3, 0, 2, 2, ";", ";", named=False),
         node(4, 0, 3, 2, "method_declaration", "odd", row=6),
         node(40, 4, 0, 3, "formal_parameters", "()"), node(41, 4, 1, 3, "identifier", "late"),
         node(5, 0, 4, 2, "method_declaration", "bare")], NODES)
    got = {r.node_id: (r.name, r.signature, r.start_line) for r in T.extract_declarations(df).collect()}
    assert got == {2: ("f", "f(int a)", 5), 4: ("late", "unknown()", 7), 5: ("unknown", "unknown", 1)}
    comments = {r.node_id: r.doc_comment for r in T.leading_comment(df).collect()}
    assert comments == {2: "/* hi */", 4: "", 5: ""}


def test_all_metrics(spark):
    df = spark.createDataFrame(
        [node(0, None, 0, 1, "program", "a b"), node(1, 0, 0, 2, "identifier", "a"), node(2, 0, 1, 2, "identifier", "b")], NODES)
    texts = spark.createDataFrame([("r", "a b")], "record_id string, text string")
    got = T.all_metrics(df, texts, with_tokens=True).first().asDict()
    assert got == dict(record_id="r", n_whitespaces=1, n_words=2, nloc=1, n_ast_nodes=3, ast_depth=2, n_identifiers=2,
                       vocab_size=2, token_counts=2, cyclomatic_complexity=1, code_tokens=["a", "b"])
