"""Captured requests, baseline limits, violations, alerts, fairness and attribution drift."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.functions import count_where, known, present, ratio
from churnwright.operators.profiling import category_values, distinct_counts, first_categories, null_profile, numeric_range, text_values
from churnwright.operators.sampling import sample_fraction


def capture(df: DataFrame, percent: float, key: str, seed: int = 42) -> DataFrame:
    """Keep ``percent`` of the traffic, chosen by the request's own key; also on a stream."""
    return sample_fraction(df, percent / 100.0, key, seed)


def parse_csv_body(df: DataFrame, body: str, headers: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A one-line, comma-separated body as named text columns. Fields past the headers are dropped.

    Bodies without a comma or with a line break are no CSV requests and are left out; ``csv_rejects`` counts them.
    """
    ddl = ", ".join("`{}` string".format(h.replace("`", "``")) for h in headers)
    parsed = df.where(csv_fault(body).isNull()).select(*keep, F.from_csv(F.col(body), ddl, {"mode": "PERMISSIVE"}).alias("_r"))
    return parsed.select(*keep, "_r.*")


def csv_fault(body: str) -> Column:
    """Why a body is no CSV request, or null."""
    return F.when(F.col(body).isNull(), "no body").when(F.col(body).contains("\n"), "more than one line").when(~F.col(body).contains(","), "no comma")


def json_fault(body: str) -> Column:
    """Why a body is no JSON object or list, or null."""
    start = F.substring(F.ltrim(F.col(body)), 1, 1)
    broken = F.try_parse_json(F.col(body)).isNull()
    return F.when(F.col(body).isNull(), "no body").when(broken, "malformed").when(~start.isin("{", "["), "no object")


def rejects(df: DataFrame, fault: Column) -> DataFrame:
    """``(reason, n)``: how many rows were left out, and why; also on a stream."""
    return df.select(fault.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as flat columns named ``outer.inner``."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    paths = leaves(df.schema, ())
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in paths])


def parse_json_body(df: DataFrame, body: str, record: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """A JSON object, or a list of objects, as flat columns; a list gives one row per object.

    Bodies that are no JSON, or neither an object nor a list, are left out; ``rejects`` with ``json_fault`` counts them.
    """
    is_list = F.ltrim(F.col(body)).startswith("[")
    many = F.from_json(F.col(body), T.ArrayType(record))
    one = F.array(F.from_json(F.col(body), record))
    rows = df.where(json_fault(body).isNull()).select(*keep, F.explode(F.when(is_list, many).otherwise(one)).alias("_r")).where("_r is not null")
    return flatten(rows.select(*keep, "_r.*"))


def json_objects(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., object)``: the JSON objects of the bodies as variants, one row per object of a list.

    Bodies that ``json_fault`` names, and list items that are no objects, are left out.
    """
    held = df.where(json_fault(body).isNull()).select(*keep, F.parse_json(F.col(body)).alias("_v"))
    is_list = F.schema_of_variant("_v").startswith("ARRAY")
    items = F.when(is_list, F.col("_v").try_cast("array<variant>")).otherwise(F.array("_v"))
    objects = held.select(*keep, F.explode(items).alias("object"))
    return objects.where(F.schema_of_variant("object").startswith("OBJECT"))


def json_shape(objects: DataFrame, col: str = "object") -> T.StructType:
    """The merged type of JSON objects of any shape: one aggregate, merged over the cluster before one row reaches the driver.

    Numbers widen to the type that holds all of them. What is of different kinds in different objects is a variant.
    """
    text = objects.groupBy().agg(F.schema_of_variant_agg(col).alias("s")).first()["s"]
    if not text.startswith("OBJECT<"):
        return T.StructType([])
    named = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")  # names in backquotes stay
    return T.DataType.fromDDL(named.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def flatten_objects(objects: DataFrame, shape: T.StructType, keep: Sequence[str] = (), col: str = "object", sep: str = ".") -> DataFrame:
    """Every leaf of ``shape`` as a column named by its path. Leaves of mixed kinds are text; lists stay lists.

    An object that lacks a leaf, or has another kind of value there than ``shape`` says, gives null.
    """

    def leaves(of: T.StructType, path: tuple[str, ...]):
        for f in of.fields:
            if isinstance(f.dataType, T.StructType) and f.dataType.fields:
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name), f.dataType

    def leaf(path: tuple[str, ...], kind: T.DataType) -> Column:
        steps = "".join(f"['{p}']" if "'" not in p else f'["{p}"]' for p in path)
        text = isinstance(kind, (T.VariantType, T.NullType, T.StructType))
        found = F.try_variant_get(F.col(col), F.lit(f"${steps}"), "string" if text else kind.simpleString())
        return found.alias(sep.join(path))

    return objects.select(*keep, *[leaf(path, kind) for path, kind in leaves(shape, ())])


def parse_any_json(df: DataFrame, body: str, keep: Sequence[str] = (), shape: T.StructType | None = None) -> DataFrame:
    """JSON objects or lists of objects, whatever keys they have, as flat columns; a list gives one row per object.

    The shape is merged from all bodies first, unless it is given (a stream needs one, say that of a captured baseline).
    """
    objects = json_objects(df, body, keep)
    return flatten_objects(objects, json_shape(objects) if shape is None else shape, keep)


def baseline_limits(df: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """``(column, kind, completeness, min, max, n_distinct, example_values)``: suggested limits from a baseline.

    The complete values of the categories are in ``profiling.category_values``.
    """
    cols = [*numeric, *categories]
    full = null_profile(df, cols).select("column", (1 - F.col("null_ratio")).alias("completeness"))
    kinds = full.join(distinct_counts(df, cols), "column")
    if numeric:
        kinds = kinds.join(numeric_range(df, numeric).select("column", "min", "max"), "column", "left")
    if categories:
        kinds = kinds.join(first_categories(df, categories).select("column", "example_values"), "column", "left")
    is_num = F.col("column").isin(list(numeric)) if numeric else F.lit(False)
    return kinds.withColumn("kind", F.when(is_num, F.lit("numeric")).otherwise(F.lit("category")))


def violations(current: DataFrame, baseline: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """``(column, rule, n)``: how many current rows breach the baseline's completeness, range or category limits.

    A category breaches if the baseline never has it, however many values a column has. Without any baseline value
    there is no category limit. NaN is missing: it counts against completeness, not against the range.
    """
    cols = [*numeric, *categories]
    known_share = lambda df, c: F.avg(present(df, c).isNotNull().cast("double"))
    kept = [known_share(baseline, c).alias(f"full{i}") for i, c in enumerate(cols)]
    for i, c in enumerate(numeric):
        v = known(F.col(c).cast("double"))
        kept += [F.min(v).alias(f"low{i}"), F.max(v).alias(f"high{i}")]
    held = baseline.groupBy().agg(*kept).select(F.struct("*").alias("m")).scalar()  # one row
    counted = []
    for i, c in enumerate(numeric):
        v = known(F.col(c).cast("double"))
        counted.append((c, "range", count_where((v < F.col(f"_m.low{i}")) | (v > F.col(f"_m.high{i}")))))
    for i, c in enumerate(cols):
        short = F.max(F.col(f"_m.full{i}")) > known_share(current, c)
        counted.append((c, "completeness", F.when(short, count_where(present(current, c).isNull())).otherwise(F.lit(0)).cast("bigint")))
    wide = current.withColumn("_m", held).agg(*[a.alias(f"c{i}") for i, (_, _, a) in enumerate(counted)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"c{i}").alias("n")) for i, (c, r, _) in enumerate(counted)])
    found = wide.select(F.inline(rows))
    if categories:
        found = found.unionByName(unknown_values(current, category_values(baseline, categories), categories))
    return found.where("n > 0")


def unknown_values(current: DataFrame, values: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``(column, rule, n)``: rows whose category is not in the complete table ``(column, value)``; columns without a value there have no limit."""
    counts = text_values(current, categories).where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    limited = counts.join(values.select("column").distinct(), "column", "left_semi")
    unseen = limited.join(values, ["column", "value"], "left_anti")
    return unseen.groupBy("column").agg(F.lit("category").alias("rule"), F.sum("n").alias("n"))


def alerts(table: DataFrame, breach: Column, kind: str, subject: str, detail: Column) -> DataFrame:
    """``(kind, subject, detail, retrain)``: the rows of a drift, violation or gate table that call for action."""
    return table.where(breach).select(
        F.lit(kind).alias("kind"), F.col(subject).cast("string").alias("subject"), detail.alias("detail"), F.lit(True).alias("retrain")
    )


def fairness(df: DataFrame, facets: Sequence[str], label: str, predicted: str, positive: int = 1) -> DataFrame:
    """Per facet: the gap in positive rate (demographic parity) and in recall (equal opportunity) between its values."""
    long = text_values(df, facets, [label, predicted]).where("value is not null")
    hit, true = F.col(predicted) == positive, F.col(label) == positive
    per = long.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), count_where(hit).alias("p"), count_where(true).alias("t"), count_where(hit & true).alias("tp")
    )
    per = per.withColumn("rate", ratio(F.col("p"), F.col("n"))).withColumn("recall", ratio(F.col("tp"), F.col("t"), None))
    return per.groupBy(F.col("column").alias("facet")).agg(
        F.count(F.lit(1)).alias("n_values"),
        (F.max("rate") - F.min("rate")).alias("parity_gap"),
        (F.max("recall") - F.min("recall")).alias("opportunity_gap"),
    )


def attribution(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float] | DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, mean_abs, rank)`` of a linear model's contributions ``w * (x - mean)``.

    ``means`` is a mapping, or a baseline table whose column means are used.
    """
    cols = list(weights)
    if isinstance(means, DataFrame):
        held = means.groupBy().agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).alias("m")).scalar()
        df = df.withColumn("_m", held)
        mean = lambda c: F.col("_m").getField(c)
    else:
        mean = lambda c: F.lit(float(means[c]))
    part = lambda c: F.abs((F.col(c).cast("double") - mean(c)) * float(weights[c]))
    wide = df.groupBy(*by).agg(*[F.avg(part(c)).alias(f"f{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"f{i}").alias("mean_abs")) for i, c in enumerate(cols)])
    long = wide.select(*by, F.inline(rows))
    # one row per feature in each window group
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("mean_abs"), "feature")
    return long.withColumn("rank", F.row_number().over(w))


def attribution_drift(base: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, base_mean_abs, mean_abs, rank_change)``."""
    b = base.select("feature", F.col("mean_abs").alias("base_mean_abs"), F.col("rank").alias("_r"))
    return current.join(F.broadcast(b), "feature").select(*by, "feature", "base_mean_abs", "mean_abs", (F.col("rank") - F.col("_r")).alias("rank_change"))
