"""Tables of one folder, and published files with a format of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import iso_date, map_frequency, map_unit, norm_tenor, period_end, to_number


def read_table(spark: SparkSession, folder: str, name: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_series_json(spark: SparkSession, path: str, key: str = "Series Key", date: str = "Observation Date", value: str = "Observation Value") -> DataFrame:
    """Series payloads {"columns": [...], "rows": [[...]]} -> (file, key, obs_date, value). Columns are found by name in
    any case; rows too short for the three are left out; blanks, NA and - are null, thousands commas go."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", "struct<columns:array<string>,rows:array<array<string>>>").alias("p"))
    names = F.transform("p.columns", lambda c: F.lower(F.trim(c)))
    at = {n: F.array_position(names, F.lit(n.lower())).cast("int") for n in (key, date, value)}
    rows = raw.select("file", F.explode("p.rows").alias("r"), *[c.alias(f"at_{i}") for i, c in enumerate(at.values())])
    rows = rows.filter("at_0 > 0 and at_1 > 0 and at_2 > 0").filter(F.size("r") >= F.greatest("at_0", "at_1", "at_2"))
    return rows.select("file", F.element_at("r", F.col("at_0")).alias("key"), F.to_date(F.element_at("r", F.col("at_1")).try_cast("timestamp")).alias("obs_date"), to_number(F.element_at("r", F.col("at_2"))).alias("value"))


def write_datasets(obs: DataFrame, catalog: DataFrame, path: str, changed: DataFrame | None = None) -> None:
    """Every live series' points with name, unit and source as gzipped CSV, one folder per dataset (the id's first part),
    sorted within range partitions. With `changed` (of changed_datasets) only the data sets to write are."""
    live = catalog.filter("is_active").select("series_id", "name", "unit", "source")
    out = obs.join(live, "series_id").withColumn("dataset", F.split_part("series_id", F.lit("."), F.lit(1)))
    if changed is not None:
        out = out.join(changed.filter("action = 'write'").select("dataset"), "dataset", "left_semi")
    out.repartitionByRange("dataset", "series_id", "obs_date").sortWithinPartitions("dataset", "series_id", "obs_date", "dims_key").write.partitionBy("dataset").option("compression", "gzip").option("header", True).mode("overwrite").option("partitionOverwriteMode", "dynamic").csv(path)


def dataset_fingerprints(obs: DataFrame) -> DataFrame:
    """Rows, series and newest revision by dataset: what a rebuild of changed files compares."""
    d = obs.withColumn("dataset", F.split_part("series_id", F.lit("."), F.lit(1)))
    return d.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("series_id").alias("n_series"), F.max("revised_at").alias("newest"))


#: What the first characters of a series payload must name for a row-by-row reading.
STANDARD_COLUMNS = ["Dataset Name", "Series Key", "Series Name", "Observation Date", "Observation Value"]


def read_series_json_lenient(spark: SparkSession, path: str) -> DataFrame:
    """Series payloads that JSON cannot read, for want of escapes in their last columns -> (file, key, obs_date, value).

    What follows `"rows"` is cut where one row ends and the next begins, and each piece's plain fields (a quoted text without
    quotes, a number, null) are counted from the left: the second is the key, the fourth the date, the fifth the value.
    Pieces with fewer fields or without a date there are no rows. Files that JSON reads, and files of other columns, give
    none."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    broken = raw.filter(F.from_json("value", "struct<columns:array<string>,rows:array<array<string>>>")["columns"].isNull())
    for name in STANDARD_COLUMNS:
        broken = broken.filter(F.contains(F.substring("value", 1, 400), F.lit(f'"{name}"')))
    body = F.substring_index("value", '"rows"', -1)
    pieces = broken.select("file", F.explode(F.split(body, r"\]\s*,\s*\[")).alias("piece"))
    field = F.lit('"[^"]*"|[-+.0-9eE]+|null')
    rows = pieces.select("file", F.slice(F.regexp_extract_all("piece", field, F.lit(0)), 1, 5).alias("f")).filter(F.size("f") == 5)
    bare = lambda n: F.trim(F.replace(F.col("f")[n], F.lit('"'), F.lit("")))
    out = rows.select("file", bare(1).alias("key"), F.try_to_date(F.substring(bare(3), 1, 10)).alias("obs_date"), to_number(bare(4)).alias("value"))
    return out.filter("obs_date is not null")


def read_dataset_meta(spark: SparkSession, path: str) -> DataFrame:
    """Catalog payloads of the same layout -> (file, source_key, name, description, unit, frequency, since, refreshed), with
    columns found under any of their names."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.from_json("value", "struct<columns:array<string>,rows:array<array<string>>>").alias("p"))
    names = F.transform("p.columns", lambda c: F.lower(F.trim(c)))
    wanted = {"source_key": ["Series Code", "Series Key"], "name": ["Series Name"], "description": ["Series Description", "Description"], "unit": ["Unit"], "frequency": ["Data Frequency", "Frequency"], "since": ["Available Since", "Available From"], "refreshed": ["Last Refresh Date", "Last Refresh"]}
    places = [F.coalesce(*[F.nullif(F.array_position(names, F.lit(a.lower())), F.lit(0)) for a in aliases]).cast("int").alias(f"at_{k}") for k, aliases in wanted.items()]
    rows = raw.select("file", F.explode("p.rows").alias("r"), *places)
    cells = {k: F.trim(F.when(F.col(f"at_{k}").isNotNull(), F.try_element_at("r", F.col(f"at_{k}")))) for k in wanted}
    out = rows.select("file", *[c.alias(k) for k, c in cells.items()]).filter("source_key <> ''")
    return out.withColumns({"unit": map_unit(F.col("unit"), F.col("name")), "frequency": map_frequency(F.col("frequency")), "since": iso_date(F.col("since")), "refreshed": iso_date(F.col("refreshed"))})


def read_curve_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily yield-curve files of a folder -> curve_rates()."""
    return curve_rates(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value"))


def curve_rates(files: DataFrame) -> DataFrame:
    """(file, value) of daily yield curves, their day in the file's name (yyyy-mm-dd or ddmmyyyy) -> (file, obs_date, tenor, rate). The
    header is the first of the first ten lines whose first cell names the tenor; the rate stands under `mid...`, else under
    an average of the panel, else in the second column. Rates of zero or less are blank quotes."""
    lines = files.select("file", F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "").alias("lines"))
    cells = lambda line: F.transform(F.split(line, ","), lambda c: F.lower(F.trim(F.replace(c, F.lit('"'), F.lit("")))))
    is_head = lambda line: F.contains(cells(line)[0], F.lit("tenor")) | (cells(line)[0] == "userid")
    at = F.array_position(F.transform(F.slice("lines", 1, 10), is_head), F.lit(True)).cast("int")
    found = lines.withColumn("at", at).filter("at > 0").withColumn("head", cells(F.element_at("lines", F.col("at"))))
    place = lambda test: F.nullif(F.array_position(F.transform("head", test), F.lit(True)), F.lit(0))
    column = F.coalesce(place(lambda c: c.startswith("mid")), place(lambda c: c.isin("fmap", "avg", "average")), F.when(F.size(F.filter("head", lambda c: c != "")) <= 3, F.lit(2).cast("long"))).cast("int")
    rows = found.withColumn("column", column).filter("column is not null").select("file", "column", F.explode(F.slice("lines", F.col("at") + 1, F.size("lines"))).alias("line")).withColumn("c", cells(F.col("line")))
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    day = F.coalesce(F.try_to_date(F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))), F.try_to_date(F.nullif(F.regexp_extract(name, r"(?<!\d)(\d{8})(?!\d)", 1), F.lit("")), "ddMMyyyy"))
    out = rows.select("file", day.alias("obs_date"), norm_tenor(F.col("c")[0]).alias("tenor"), F.try_element_at("c", F.col("column")).try_cast("double").alias("rate"))
    return out.filter("tenor is not null and rate > 0")


def read_chart_json(pages: DataFrame, frequency: str) -> DataFrame:
    """pages (page, html) -> (page, name, obs_date, value) of the page's primary chart: the first `categories` array gives the
    periods, and of the series behind it the first of each name with as many values counts. Null values are left out."""
    first = r'"?categories"?\s*:\s*(\[[^\]]*\])'
    labels = F.from_json(F.regexp_extract("html", first, 1), "array<string>")
    chart = pages.select("page", labels.alias("labels"), F.expr("substring(html, locate('categories', html))").alias("rest")).filter("labels is not null")
    series = r'"?name"?\s*:\s*["\']([^"\']+)["\']\s*,\s*"?data"?\s*:\s*(\[[^\]]*\])'
    found = chart.select("page", "labels", F.posexplode(F.regexp_extract_all("rest", F.lit(series), F.lit(0))).alias("place", "s"))
    found = found.select("page", "labels", "place", F.trim(F.regexp_extract("s", series, 1)).alias("name"), F.from_json(F.regexp_extract("s", series, 2), "array<double>").alias("data")).filter(F.size("data") == F.size("labels"))
    best = found.groupBy("page", "name").agg(F.min_by(F.struct("labels", "data"), "place").alias("f"))
    points = best.select("page", "name", F.explode(F.arrays_zip(F.col("f.labels").alias("label"), F.col("f.data").alias("value"))).alias("p"))
    return points.select("page", "name", period_end(F.col("p.label"), frequency).alias("obs_date"), F.col("p.value").alias("value")).filter("obs_date is not null and value is not null")


def read_packed_csv(spark: SparkSession, path: str, schema: str, partitions: int) -> DataFrame:
    """Gzipped CSV with a header line. A gzip file is one task however large, so the rows are dealt out behind it."""
    return spark.read.schema(schema).option("header", True).csv(path).repartition(partitions)


def read_packed_json(spark: SparkSession, path: str, schema: str, partitions: int) -> DataFrame:
    """Gzipped JSON lines, dealt out likewise."""
    return spark.read.schema(schema).json(path).repartition(partitions)


def changed_datasets(fresh: DataFrame, last: DataFrame) -> DataFrame:
    """Fingerprints of this and the last export -> (dataset, action): `write` where anything differs, `drop` for data sets that
    are gone; those that are the same are left out."""
    cols = ["n_rows", "n_series", "newest"]
    j = fresh.select("dataset", F.struct(*cols).alias("a")).join(last.select("dataset", F.struct(*cols).alias("b")), "dataset", "full_outer")
    return j.filter(~F.col("a").eqNullSafe(F.col("b"))).select("dataset", F.when(F.col("a").isNull(), "drop").otherwise("write").alias("action"))
