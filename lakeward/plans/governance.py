"""Governance rules over metadata tables: path allowlists, naming and tag
lint, documentation coverage, sensitivity, ownership and lineage.

Each rule is a DataFrame transformation over a metadata table (paths,
catalog listings, model/column declarations, lineage edges) and returns the
violations (or the selected rows), so the same code checks ten names or ten
million.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import qcol
from ..session import ensure_checkpoint_dir, shared_dir

# ----------------------------------------------------------------- P09

INCLUDE_ALL = "*"


def selector_lines(text: str) -> list[str]:
    """The lines of a selector that count: not blank, not a ``#`` comment."""
    return [line for line in map(str.strip, text.splitlines()) if line and line[0] != "#"]


def _selected_in_its_folder(rel: Column, pattern: str) -> Column:
    # Text up to the end of the leftmost match: a lazy prefix before the
    # pattern finds the leftmost start, as a regex search does.
    upto = F.regexp_extract(rel, f"(?s)^.*?(?:{pattern})", 0)
    rest = F.regexp_replace(F.substr(rel, F.length(upto) + 1), "^/+", "")
    return F.regexp_like(rel, F.lit(pattern)) & ~rest.contains("/")


def select_paths(df: DataFrame, path_column: str, selector_text: str | None, root: str) -> DataFrame:
    """Keep rows whose path the selector includes.

    A pattern includes a path (relative to ``root``) when it matches
    somewhere and no deeper folder follows the match.  Paths outside ``root``
    are kept; no selector, or one with a ``*`` line, keeps all.  The patterns come from one small selector text, so they are
    compiled into one filter expression (no join, no broadcast).
    """
    patterns = [INCLUDE_ALL] if selector_text is None else selector_lines(selector_text)
    if INCLUDE_ALL in patterns:
        return df
    root_prefix = root if root.endswith("/") else root + "/"
    path = qcol(path_column)
    inside = path.startswith(root_prefix)
    rel = F.substr(path, F.lit(len(root_prefix) + 1))
    if patterns:
        any_match = reduce(lambda a, b: a | b, [_selected_in_its_folder(rel, p) for p in patterns])
    else:
        any_match = F.lit(False)
    return df.filter(~inside | any_match)


# ----------------------------------------------------------------- P10 / P11

# Layer prefixes of schema names and the tag dimensions.
SCHEMA_LAYER_PATTERN = r"^(000_ref|001_bnz|002_slv|003_gld)_[a-z0-9_]+$"
SNAKE_CASE = r"^[a-z0-9_]+$"
TABLE_LAYER_PREFIX = r"^(ref|bnz|slv|gld|bronze|silver|gold)_"
VIEW_PATTERN = r"^vw_[a-z0-9]+(_[a-z0-9]+)*_[a-z0-9]+$"
MAX_IDENTIFIER_BYTES = 63
TAG_DIMENSIONS = ("sistema", "orgao", "camada", "dominio")
MANDATORY_TAG = "sistema"


def name_violations(objects: DataFrame) -> DataFrame:
    """Naming rules over a catalog listing ``(schema_name, object_name,
    object_type)`` with ``object_type`` in ``table``/``view``.

    Returns one row per broken rule: ``schema_name, object_name, rule``."""
    s, o, t = F.col("schema_name"), F.col("object_name"), F.lower(F.col("object_type"))
    rules = [
        ("schema_layer_prefix", ~s.rlike(SCHEMA_LAYER_PATTERN)),
        ("schema_too_long", F.octet_length(s) > MAX_IDENTIFIER_BYTES),
        ("object_not_snake_case", ~o.rlike(SNAKE_CASE)),
        ("object_too_long", F.octet_length(o) > MAX_IDENTIFIER_BYTES),
        ("table_has_layer_prefix", (t == "table") & o.rlike(TABLE_LAYER_PREFIX)),
        ("view_name_pattern", (t == "view") & ~o.rlike(VIEW_PATTERN)),
    ]
    parts = [
        objects.filter(cond).select("schema_name", "object_name", F.lit(rule).alias("rule"))
        for rule, cond in rules
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def catalog_objects(spark: SparkSession, schemas: list[str] | None = None) -> DataFrame:
    """The live catalog as ``(schema_name, object_name, object_type)`` for
    :func:`name_violations` (metadata only; one row per table or view)."""
    names = schemas or [d.name for d in spark.catalog.listDatabases()]
    rows = []
    for db in names:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            rows.append((db, t.name, "view" if (t.tableType or "").upper() == "VIEW" else "table"))
    return spark.createDataFrame(rows, "schema_name string, object_name string, object_type string")


def tag_violations(pipelines: DataFrame) -> DataFrame:
    """Tag rules over ``(pipeline_id, tags ARRAY<STRING>)``: every tag is
    ``{dimension}:{snake_value}`` with a known dimension, and a ``sistema``
    tag is present.  Returns ``pipeline_id, tag, rule``."""
    dims = "|".join(TAG_DIMENSIONS)
    tag_re = rf"^({dims}):[a-z0-9_]+$"
    bad = pipelines.select("pipeline_id", F.explode_outer("tags").alias("tag")).filter(
        F.col("tag").isNotNull() & ~F.col("tag").rlike(tag_re)
    ).select("pipeline_id", "tag", F.lit("tag_format").alias("rule"))
    missing = pipelines.filter(
        ~F.exists(F.coalesce(F.col("tags"), F.array().cast("array<string>")), lambda x: x.startswith(MANDATORY_TAG + ":"))
    ).select("pipeline_id", F.lit(None).cast("string").alias("tag"), F.lit("missing_sistema_tag").alias("rule"))
    return bad.unionByName(missing)


# ----------------------------------------------------------------- Q11 / Q12

# Sensitivity classes from least to most restrictive, and the
# class assumed for a column that declares none.
SENSITIVITY_ORDER = ("publico", "interno", "pessoal", "pessoal_sensivel")
DEFAULT_SENSITIVITY = "pessoal"


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _rank_of(c: Column) -> Column:
    expr = F.lit(None).cast("int")
    for i, name in enumerate(SENSITIVITY_ORDER):
        expr = F.when(c == name, F.lit(i)).otherwise(expr)
    return expr


def model_classification(columns: DataFrame) -> DataFrame:
    """Per model, the most restrictive class among its columns; a column
    without a class counts as ``pessoal``.  Input ``(model, column,
    classification)``; output ``model, classification``."""
    cls = F.coalesce(F.col("classification"), F.lit(DEFAULT_SENSITIVITY))
    ranked = columns.select("model", _rank_of(cls).alias("rank"))
    names = F.array(*[F.lit(n) for n in SENSITIVITY_ORDER])
    return ranked.groupBy("model").agg(F.max("rank").alias("rank")).select(
        "model", F.element_at(names, F.col("rank") + 1).alias("classification")
    )


# Schema prefixes of the layers.  Model metadata lives in table
# properties under ``lakeward.`` (Spark reserves a bare ``owner``).
LAYER_BY_PREFIX = {"000_ref": "reference", "001_bnz": "bronze", "002_slv": "silver", "003_gld": "gold"}
MODEL_PROPERTIES = ("owner", "origin", "classification", "business_question")
PROPERTY_PREFIX = "lakeward."


def catalog_documentation(spark: SparkSession, schemas: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(models, columns)`` for :func:`documentation_violations`, read from
    the live catalog: table comments and properties (``owner``, ``origin``,
    ``classification``, ``business_question``, each under ``lakeward.``;
    ``lakeward.calculation_rule.{column}`` marks a calculated column) and
    column comments, i.e. what :func:`lakeward.plans.tables.apply_comments`
    and table properties record.  Metadata only; one row per table and per
    column."""
    models, cols = [], []
    for db in schemas:
        layer = next((v for k, v in LAYER_BY_PREFIX.items() if db.startswith(k + "_")), None)
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            name = f"{db}.{t.name}"
            props = {
                r["key"]: r["value"]
                for r in spark.sql(f"SHOW TBLPROPERTIES `{db}`.`{t.name}`").collect()
            }
            models.append((name, layer, t.description, *[props.get(PROPERTY_PREFIX + k) for k in MODEL_PROPERTIES]))
            for c in spark.catalog.listColumns(f"`{db}`.`{t.name}`"):
                rule_key = f"{PROPERTY_PREFIX}calculation_rule.{c.name}"
                cols.append((name, c.name, c.description, props.get(rule_key), rule_key in props))
    m = spark.createDataFrame(
        models,
        "model string, layer string, description string, owner string, origin string, "
        "classification string, business_question string",
    )
    c = spark.createDataFrame(
        cols, "model string, column string, description string, calculation_rule string, is_calculated boolean"
    )
    return m, c


def documentation_violations(models: DataFrame, columns: DataFrame) -> DataFrame:
    """Documentation rules by layer.

    ``models``: ``(model, layer, description, owner, origin, classification,
    business_question)``; ``columns``: ``(model, column, description,
    calculation_rule, is_calculated)``.  Bronze needs description, owner,
    origin and class on the model; silver adds a description on every column;
    gold adds the business question and a rule on calculated columns.
    Returns ``model, column, rule`` (``column`` null for model rules)."""
    layer = F.lower(F.col("layer"))
    model_rules = [
        ("model_description", _blank(F.col("description"))),
        ("model_owner", _blank(F.col("owner"))),
        ("model_origin", _blank(F.col("origin"))),
        ("model_classification", _blank(F.col("classification"))),
        ("gold_business_question", (layer == "gold") & _blank(F.col("business_question"))),
    ]
    m = reduce(
        lambda a, b: a.unionByName(b),
        [
            models.filter(cond).select("model", F.lit(None).cast("string").alias("column"), F.lit(r).alias("rule"))
            for r, cond in model_rules
        ],
    )
    joined = columns.join(models.select("model", "layer"), "model", "inner")
    col_layer = F.lower(F.col("layer"))
    col_rules = [
        ("column_description", col_layer.isin("silver", "gold") & _blank(F.col("description"))),
        (
            "gold_calculation_rule",
            (col_layer == "gold") & F.coalesce(F.col("is_calculated"), F.lit(False)) & _blank(F.col("calculation_rule")),
        ),
    ]
    c = reduce(
        lambda a, b: a.unionByName(b),
        [joined.filter(cond).select("model", "column", F.lit(r).alias("rule")) for r, cond in col_rules],
    )
    return m.unionByName(c)


# ----------------------------------------------------------------- Q13 / Q14 / L09


def owner_mismatches(pipelines: DataFrame, outputs: DataFrame, models: DataFrame) -> DataFrame:
    """Pipelines whose owner differs from the owner of a table they feed.
    ``pipelines (pipeline_id, owner)``, ``outputs (pipeline_id, model)``,
    ``models (model, owner)``."""
    p = pipelines.select("pipeline_id", F.col("owner").alias("pipeline_owner"))
    m = models.select("model", F.col("owner").alias("model_owner"))
    return (
        outputs.join(p, "pipeline_id").join(m, "model")
        .filter(~F.col("pipeline_owner").eqNullSafe(F.col("model_owner")))
        .select("pipeline_id", "model", "pipeline_owner", "model_owner")
    )


def lineage_breaks(outputs: DataFrame, inputs: DataFrame, final_layers=("gold",)) -> DataFrame:
    """Declared outputs ``(pipeline_id, dataset, layer)`` that no pipeline
    reads (``inputs (pipeline_id, dataset)``), except final-layer datasets."""
    consumed = inputs.select("dataset").distinct()
    return outputs.filter(~F.lower(F.col("layer")).isin(*final_layers)).join(consumed, "dataset", "left_anti")


def lineage_closure(spark: SparkSession, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All ``(src, dst, depth)`` reachable pairs over ``edges (src, dst)``
    with the shortest depth.  Steps go on until no new pair is found; if ``max_depth`` is given and pairs beyond it
    exist, ``ValueError`` is raised instead of returning a part.

    Semi-naive breadth-first search: each step joins only the pairs found in
    the previous step (the frontier) with the edges and keeps the pairs not
    reached before (left-anti join), so the work is bounded by the number of
    distinct pairs, however many walks a dense or cyclic graph has.  Each
    step's result is checkpointed to the shared folder, which cuts the
    lineage; steps are bounded by the longest shortest path."""
    ensure_checkpoint_dir(spark)
    e = edges.select("src", "dst").distinct().checkpoint()
    frontier = e
    steps = [frontier.withColumn("depth", F.lit(1))]

    def seen() -> DataFrame:
        # union of checkpointed steps: every branch is a shallow scan
        return reduce(lambda a, b: a.unionByName(b), [s.select("src", "dst") for s in steps])

    depth = 1
    while True:
        depth += 1
        step = (
            frontier.alias("f")
            .join(e.alias("e"), F.col("f.dst") == F.col("e.src"))
            .select(F.col("f.src").alias("src"), F.col("e.dst").alias("dst"))
            .distinct()
            .join(seen(), ["src", "dst"], "left_anti")
            .checkpoint()
        )
        if step.isEmpty():
            break
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"the lineage goes on beyond {max_depth} steps")
        steps.append(step.withColumn("depth", F.lit(depth)))
        frontier = step
    return reduce(lambda a, b: a.unionByName(b), steps)


def reachable_from(spark: SparkSession, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``(node, depth)`` of everything that the edges ``(src, dst)`` lead to
    from the nodes of ``roots (node)``, themselves included at depth 0, with
    the fewest steps.

    A breadth-first search of frontiers: each step joins only the nodes found
    in the last one with the edges and leaves out those found before, so cycles
    end, every edge is followed once, and the result has at most one row per
    node, however many paths there are.  Steps are written to the shared
    folder; null nodes are no nodes."""
    folder = shared_dir(spark, "reach", unique=True)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    known = edges.filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct()
    known = kept(known, "edges")
    depth = 0
    frontier = kept(roots.select("node").filter("node IS NOT NULL").distinct(), "step=0")
    while not frontier.isEmpty():
        depth += 1
        steps = [spark.read.schema(frontier.schema).parquet(f"{folder}/step={k}") for k in range(depth)]
        found = reduce(DataFrame.unionByName, steps)
        ahead = frontier.join(known, frontier["node"] == known["src"]).select(F.col("dst").alias("node")).distinct()
        frontier = kept(ahead.join(found, "node", "left_anti"), f"step={depth}")
    steps = [
        spark.read.schema(frontier.schema).parquet(f"{folder}/step={k}").withColumn("depth", F.lit(k))
        for k in range(depth + 1)
    ]
    return reduce(DataFrame.unionByName, steps)


# Layer order of the one-way flow.
LAYER_RANK = {"landing": 0, "bronze": 1, "silver": 2, "gold": 3}


def layer_flow_violations(edges: DataFrame) -> DataFrame:
    """One-way rule over ``(src, src_layer, dst, dst_layer)``: bronze is fed
    from landing, silver only from bronze, gold only from silver."""
    def rank(c):
        expr = F.lit(None).cast("int")
        for name, r in LAYER_RANK.items():
            expr = F.when(F.lower(c) == name, F.lit(r)).otherwise(expr)
        return expr

    return edges.filter(
        rank(F.col("src_layer")).isNull() | rank(F.col("dst_layer")).isNull()
        | (rank(F.col("dst_layer")) != rank(F.col("src_layer")) + 1)
    )
