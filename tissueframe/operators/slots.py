"""Rules over the image slots of a run and their records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def validate_slots(slots: DataFrame, supported: DataFrame) -> DataFrame:
    """Module flags in long form, switched off where the technology is not supported.

    ``slots(run, slot, tech, module, flag)`` and ``supported(tech, module)``;
    ``warning`` names what was switched off.
    """
    known = supported.select("tech", "module").distinct().withColumn("_ok", F.lit(True))
    joined = slots.join(known, ["tech", "module"], "left")
    off = F.col("flag") & F.col("_ok").isNull()
    return joined.select("run", "slot", "tech", "module", (F.col("flag") & ~off).alias("flag"), F.when(
        off, F.concat_ws(" ", F.col("tech"), F.lit("not supported by"), F.col("module"))).alias("warning"))


def image_size_consistency(slots: DataFrame) -> DataFrame:
    """Slots whose size differs from the slot they are aligned to."""
    other = slots.select("run", F.col("slot").alias("target"), F.col("w").alias("target_w"), F.col("h").alias("target_h"))
    own = slots.select("run", "slot", F.col("channel_align").cast("long").alias("target"), "w", "h")
    return own.join(other, ["run", "target"]).where("w <> target_w or h <> target_h")


def reuse_registration(slots: DataFrame, *carry: str) -> DataFrame:
    """Registration of each slot: its own, or that of the slot named by ``reuse``."""
    src = slots.select("run", F.col("slot").alias("_src"), *[F.col(c).alias(f"_{c}") for c in carry])
    own = slots.select("run", "slot", "tech", F.col("reuse").cast("long").alias("reuse"), *carry)
    joined = own.join(src.withColumnRenamed("run", "_run"),
                      (F.col("run") == F.col("_run")) & (F.col("reuse") == F.col("_src")), "left")
    shared = F.col("reuse") >= 0
    return joined.select("run", "slot", "tech", F.when(shared, F.col("_src")).otherwise(F.col("slot")).alias("source_slot"),
                         *[F.when(shared, F.col(f"_{c}")).otherwise(F.col(c)).alias("score" if len(carry) == 1 else c)
                           for c in carry])


def scope_transform_params(slots: DataFrame) -> DataFrame:
    """Scale, rotation and offset per slot: own, else from the chip box, else from the reused slot.

    ``slots(run, slot, reuse, scale, rotation, dx, dy, box_scale, box_rotation)``
    with NULL where a record has no value; the transform applies the inverse scale.
    """
    src = slots.select(F.col("run").alias("_run"), F.col("slot").alias("_src"), F.col("scale").alias("_scale"),
                       F.col("rotation").alias("_rot"), F.col("dx").alias("_dx"), F.col("dy").alias("_dy"))
    j = slots.join(src, (F.col("run") == F.col("_run")) & (F.col("reuse") == F.col("_src")), "left")
    scale = F.coalesce("scale", "box_scale", "_scale")
    return j.select("run", "slot", F.try_divide(F.lit(1.0), scale).alias("scale"),
                    F.coalesce("rotation", "box_rotation", "_rot", F.lit(0.0)).alias("rotation"),
                    F.coalesce("dx", "_dx", F.lit(0.0)).alias("dx"), F.coalesce("dy", "_dy", F.lit(0.0)).alias("dy"),
                    F.when(F.col("scale").isNotNull(), "own").when(F.col("box_scale").isNotNull(), "chip_box")
                    .when(F.col("_scale").isNotNull(), "reused").otherwise("none").alias("source"))


def best_layer(record_fields: DataFrame) -> DataFrame:
    """Main stain of each run: the layer with most filled fields; ties by name."""
    n = record_fields.where("value is not null").groupBy("run", "layer").agg(F.count("*").alias("n"))
    top = n.groupBy("run").agg(F.min(F.struct((-F.col("n")).alias("nn"), "layer")).alias("m"))
    return top.select("run", F.col("m.layer").alias("layer"), (-F.col("m.nn")).alias("fields"))


def image_report(record: DataFrame, resolution: float = 0.0005) -> DataFrame:
    """Key-value rows of a record ``(run, layer, w, h, ...)``: sizes in millimetres and the number of images of the run."""
    rest = [c for c in record.columns if c not in ("run", "layer", "w", "h")]
    sized = record.withColumns({"width_mm": F.round(F.col("w") * resolution, 3),
                                "height_mm": F.round(F.col("h") * resolution, 3),
                                "images": F.count("*").over(Window.partitionBy("run"))})
    text = [F.col(c).cast("string").alias(c) for c in ("width_mm", "height_mm", "images", *rest)]
    return sized.unpivot(["run", "layer"], text, "name", "value").where("value is not null")
