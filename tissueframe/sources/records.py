"""Parameter files, image records, file listings, kit templates and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_SLOT = """struct<file_path:string, tech_type:string, chip_detect:boolean, quality_control:boolean,
 tissue_segmentation:boolean, cell_segmentation:boolean, correct_r:int, channel_align:int,
 registration:struct<fixed_image:int, trackline:boolean, reuse:int>>"""
_MOLECULAR = "struct<exp_matrix:int, cell_mask:map<string,array<int>>, extra_method:string, correct_r:int>"
_RUN = "struct<qc:boolean, alignment:boolean, matrix_extract:boolean, report:boolean, annotation:boolean>"
PARAMS = f"image_process map<string,{_SLOT}>, molecular_classify map<string,{_MOLECULAR}>, run {_RUN}"


def _read_json(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    return spark.read.json(path, schema=PARAMS, multiLine=multiline).withColumn("file", F.input_file_name())


def read_params(spark: SparkSession, path: str, multiline: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parameter documents to (image slots, molecular slots, run switches), one row each."""
    doc = _read_json(spark, path, multiline)
    slots = doc.select("file", F.explode("image_process").alias("slot", "s")).select("file", F.col("slot").cast("int").alias("slot"), "s.*")
    slots = slots.select(*[c for c in slots.columns if c != "registration"], "registration.*")
    mol = doc.select("file", F.explode("molecular_classify").alias("slot", "m")).select("file", F.col("slot").cast("int").alias("slot"), "m.*")
    return slots, mol, doc.select("file", "run.*")


def kit_table(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Kit templates of a folder to one distinct row per kit and stain."""
    doc = _read_json(spark, path, multiline)
    kit = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.json.*$", "")
    radius = F.array_max(F.transform(F.map_values("molecular_classify"), lambda m: m["correct_r"]))
    rows = doc.select(kit.alias("kit"), radius.alias("radius"), "run", F.explode("image_process").alias("slot", "s"))
    return rows.select("kit", F.col("s.tech_type").alias("stain"), "s.chip_detect", "s.quality_control", "s.tissue_segmentation",
                       "s.cell_segmentation", "radius", "run.qc", "run.alignment", "run.matrix_extract", "run.report").dropDuplicates()


# Record sections that are reported, and fields left out of them.
REPORTED = ("ImageInfo", "QCInfo", "Register")
HIDDEN = ("ManualState", "Preview", "Switch", "version")


def key_metrics(record: DataFrame, keys: tuple[str, ...] = ("chip", "layer")) -> DataFrame:
    """Reported scalar fields of a nested record in long form; other sections are not read."""
    cols = []
    for section in REPORTED:
        if section not in record.columns:
            continue
        for field in record.schema[section].dataType.fields:
            if field.name not in HIDDEN and field.dataType.simpleString().split("<")[0] not in ("array", "map", "struct"):
                cols.append(F.col(f"{section}.{field.name}").cast("string").alias(f"{section}__{field.name}"))
    flat = record.select(*keys, *cols)
    long = flat.unpivot(list(keys), [c for c in flat.columns if c not in keys], "key", "value").where("value is not null")
    return long.select(*keys, F.substring_index("key", "__", 1).alias("section"), F.substring_index("key", "__", -1).alias("name"), "value")


def scan_fov_listing(paths: DataFrame, pattern: str = "*_{xxx}_{xxx}_*", index0: bool = True) -> DataFrame:
    """File paths to (row, column) by a name pattern whose two ``{..}`` are numbers; a mismatch is an error."""
    regex, rest = "", pattern
    while rest:
        if rest[0] == "{":
            regex, rest = regex + r"(\d+)", rest[rest.index("}") + 1:]
        else:
            regex, rest = regex + (r".*" if rest[0] == "*" else "\\" + rest[0] if not rest[0].isalnum() and rest[0] != "_" else rest[0]), rest[1:]
    name = F.element_at(F.split("path", "/"), -1)
    shift = 0 if index0 else 1
    part = lambda i: F.regexp_extract(name, f"^{regex}$", i).cast("long") - shift
    known = name.rlike(f"^{regex}$")
    checked = F.when(known, part(1)).otherwise(F.raise_error(F.concat(F.lit("file name does not fit the pattern: "), name)))
    return paths.select("path", checked.cast("long").alias("r"), part(2).alias("c"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; the file contents are pruned from the scan."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def write_metrics(metric: DataFrame, path: str) -> None:
    """Metrics ``(chip, section, name, value)`` as one nested document per chip and section."""
    doc = metric.groupBy("chip", "section").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("metrics"))
    doc.write.json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    doc = spark.read.json(path, schema="chip bigint, section string, metrics map<string,string>")
    return doc.select("chip", "section", F.explode("metrics").alias("name", "value"))
