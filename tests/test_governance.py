"""Governance: allowlist selection, naming, tags, docs, classes, lineage."""

from lakeward.plans import governance as g

ROOT = "/srv/pipelines/dags"


def paths(spark, items):
    return spark.createDataFrame([(p,) for p in items], "path string")


def selected(spark, text, items):
    return sorted(r.path for r in g.select_paths(paths(spark, items), "path", text, ROOT).collect())


def test_no_selector_or_star_includes_all(spark):
    items = [f"{ROOT}/a/dag.py", f"{ROOT}/b/c/dag.py"]
    assert selected(spark, None, items) == sorted(items)
    assert selected(spark, "# comment\n*\n", items) == sorted(items)


def test_pattern_excludes_deeper_folders(spark):
    inc = f"{ROOT}/data_ingest/compras_gov/dag.py"
    exc = f"{ROOT}/data_ingest/compras_gov/mir/dag.py"
    assert selected(spark, "data_ingest/compras_gov/\n", [inc, exc]) == [inc]


def test_comments_and_blanks_ignored(spark):
    inc = f"{ROOT}/x/dag.py"
    assert selected(spark, "\n# x/\n   \nx/\n", [inc, f"{ROOT}/y/dag.py"]) == [inc]


def test_only_comments_selects_nothing_inside_root(spark):
    assert selected(spark, "# nothing\n", [f"{ROOT}/x/dag.py"]) == []


def test_outside_root_included(spark):
    out = "/elsewhere/dag.py"
    assert selected(spark, "x/\n", [out]) == [out]


def test_match_then_remainder(spark):
    # the leftmost match decides; a trailing slash after the match is stripped
    items = [f"{ROOT}/a/b/dag.py", f"{ROOT}/a/b/c/dag.py", f"{ROOT}/z/a/b/dag.py"]
    assert selected(spark, "a/b\n", items) == [f"{ROOT}/a/b/dag.py", f"{ROOT}/z/a/b/dag.py"]


def test_name_violations(spark):
    objs = spark.createDataFrame(
        [
            ("001_bnz_siafem", "itens", "table"),
            ("002_slv_material", "slv_itens", "table"),
            ("silver", "Itens-X", "table"),
            ("003_gld_kpi", "vw_itens_mes", "view"),
            ("003_gld_kpi", "itens_view", "view"),
        ],
        "schema_name string, object_name string, object_type string",
    )
    got = sorted((r.object_name, r.rule) for r in g.name_violations(objs).collect())
    assert got == [
        ("Itens-X", "object_not_snake_case"),
        ("Itens-X", "schema_layer_prefix"),
        ("itens_view", "view_name_pattern"),
        ("slv_itens", "table_has_layer_prefix"),
    ]


def test_tag_violations(spark):
    p = spark.createDataFrame(
        [("a", ["sistema:siape", "camada:silver"]), ("b", ["orgao:mir", "Team:X"]), ("c", None)],
        "pipeline_id string, tags array<string>",
    )
    got = sorted((r.pipeline_id, r.tag or "", r.rule) for r in g.tag_violations(p).collect())
    assert got == [("b", "", "missing_sistema_tag"), ("b", "Team:X", "tag_format"), ("c", "", "missing_sistema_tag")]


def test_classification(spark):
    cols = spark.createDataFrame(
        [("m1", "a", "publico"), ("m1", "b", "interno"), ("m2", "a", "publico"), ("m2", "b", None), ("m3", "x", "pessoal_sensivel")],
        "model string, column string, classification string",
    )
    got = {r.model: r.classification for r in g.model_classification(cols).collect()}
    assert got == {"m1": "interno", "m2": "pessoal", "m3": "pessoal_sensivel"}


def test_documentation_violations(spark):
    models = spark.createDataFrame(
        [
            ("b1", "bronze", "d", "team", "siape", "interno", None),
            ("s1", "silver", "d", "team", "siape", "interno", None),
            ("g1", "gold", "d", "", "siape", "interno", None),
        ],
        "model string, layer string, description string, owner string, origin string, classification string, business_question string",
    )
    cols = spark.createDataFrame(
        [("b1", "x", None, None, False), ("s1", "x", None, None, False), ("g1", "kpi", "total", None, True)],
        "model string, column string, description string, calculation_rule string, is_calculated boolean",
    )
    got = sorted((r.model, r.column or "", r.rule) for r in g.documentation_violations(models, cols).collect())
    assert got == [
        ("g1", "", "gold_business_question"),
        ("g1", "", "model_owner"),
        ("g1", "kpi", "gold_calculation_rule"),
        ("s1", "x", "column_description"),
    ]


def test_owner_and_lineage(spark):
    pipes = spark.createDataFrame([("p1", "team_a"), ("p2", "team_b")], "pipeline_id string, owner string")
    outs = spark.createDataFrame([("p1", "m1"), ("p2", "m2")], "pipeline_id string, model string")
    models = spark.createDataFrame([("m1", "team_a"), ("m2", "team_c")], "model string, owner string")
    assert [r.pipeline_id for r in g.owner_mismatches(pipes, outs, models).collect()] == ["p2"]
    outputs = spark.createDataFrame(
        [("ingest", "landing/x", "landing"), ("promote", "bronze/x", "bronze"), ("gold", "gold/x", "gold")],
        "pipeline_id string, dataset string, layer string",
    )
    inputs = spark.createDataFrame([("promote", "landing/x")], "pipeline_id string, dataset string")
    assert [r.dataset for r in g.lineage_breaks(outputs, inputs).collect()] == ["bronze/x"]


def test_lineage_closure(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")], "src string, dst string")
    got = {(r.src, r.dst): r.depth for r in g.lineage_closure(spark, edges).collect()}
    assert got[("a", "d")] == 3 and got[("a", "b")] == 1 and ("x", "d") not in got and len(got) == 7


def test_layer_flow(spark):
    e = spark.createDataFrame(
        [("l", "landing", "b", "bronze"), ("b", "bronze", "s", "silver"), ("b", "bronze", "g", "gold"), ("s", "silver", "g", "gold")],
        "src string, src_layer string, dst string, dst_layer string",
    )
    assert [(r.src, r.dst) for r in g.layer_flow_violations(e).collect()] == [("b", "g")]


def test_lineage_closure_cycle_and_diamonds(spark):
    # a diamond repeated 6 times plus a cycle: walks double per level, pairs do not
    edges = []
    for i in range(6):
        edges += [(f"n{i}", f"a{i}"), (f"n{i}", f"b{i}"), (f"a{i}", f"n{i+1}"), (f"b{i}", f"n{i+1}")]
    edges += [("n6", "n0")]
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {(r.src, r.dst): r.depth for r in g.lineage_closure(spark, e, max_depth=40).collect()}
    assert got[("n0", "n6")] == 12 and got[("n6", "n6")] == 13


def test_name_lint_on_live_catalog(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS `002_slv_lint_demo`")
    spark.sql("CREATE TABLE IF NOT EXISTS `002_slv_lint_demo`.itens (a STRING) USING parquet")
    spark.sql("CREATE TABLE IF NOT EXISTS `002_slv_lint_demo`.slv_itens (a STRING) USING parquet")
    spark.sql("CREATE OR REPLACE VIEW `002_slv_lint_demo`.vw_itens_mes AS SELECT * FROM `002_slv_lint_demo`.itens")
    objs = g.catalog_objects(spark, ["002_slv_lint_demo"])
    assert sorted((r.object_name, r.object_type) for r in objs.collect()) == [
        ("itens", "table"), ("slv_itens", "table"), ("vw_itens_mes", "view")
    ]
    assert [(r.object_name, r.rule) for r in g.name_violations(objs).collect()] == [("slv_itens", "table_has_layer_prefix")]


def test_documentation_from_live_catalog(spark):
    from lakeward.plans import tables

    spark.sql("CREATE SCHEMA IF NOT EXISTS `002_slv_docs_demo`")
    spark.sql("CREATE TABLE IF NOT EXISTS `002_slv_docs_demo`.itens (codigo STRING, valor STRING) USING parquet")
    tables.apply_comments(spark, "002_slv_docs_demo", "itens", "items per month", {"codigo": "item code"})
    spark.sql(
        "ALTER TABLE `002_slv_docs_demo`.itens SET TBLPROPERTIES "
        "('lakeward.owner' = 'team_a', 'lakeward.origin' = 'siads', 'lakeward.classification' = 'interno')"
    )
    models, cols = g.catalog_documentation(spark, ["002_slv_docs_demo"])
    got = sorted((r.column or "", r.rule) for r in g.documentation_violations(models, cols).collect())
    assert got == [("valor", "column_description")]
