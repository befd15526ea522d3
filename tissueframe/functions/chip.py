"""Chip serial numbers, kits and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Letters a serial number may start with, the two large-format
# letters, the row letters in order, letters not used in positions, the first
# serial numbers of the later production per format, and the pitch of one chip.
TITLE_LETTERS = "ABCDYEFGHQJKLMNPS"
LARGE_LETTERS = "YQ"
ROW_LETTERS = "ACDEFG"
UNUSED_LETTERS = "BIO"
LATE_SMALL, LATE_LARGE = 3205, 395
FOV_EDGE, FOVS_PER_CHIP, MARGIN = 2940, 6.8, 0.2


def _at(sn: Column, pos: int) -> Column:
    return F.substring(sn, pos, 1)


def name_type(sn: Column) -> Column:
    """``short``, ``long`` or ``unknown`` from length and letter rules."""
    n = F.length(sn)
    first_ok = F.instr(F.lit(TITLE_LETTERS), _at(sn, 1)) > 0
    seventh = _at(sn, 7).rlike("^[A-Za-z]$")
    eighth = (n != 8) | (F.instr(F.lit(LARGE_LETTERS), _at(sn, 1)) > 0) | _at(sn, 8).rlike("^[0-9]$")
    return (F.when((n == 0) | ~first_ok, "unknown")
            .when(n.isin(8, 10) & seventh & eighth, "short")
            .when(n.isin(14, 16, 17, 18), "long").otherwise("unknown"))


def is_large(sn: Column) -> Column:
    return (name_type(sn) != "unknown") & (F.instr(F.lit(LARGE_LETTERS), _at(sn, 1)) > 0)


def chip_spec(sn: Column) -> tuple[Column, Column]:
    """Width and height in chips, from the position suffix; (1, 1) when it cannot be read."""
    kind = name_type(sn)
    tail = F.when(kind == "short", F.substring(sn, -4, 4)).otherwise(F.element_at(F.split(sn, "_"), -1))
    a, x0, b, x1 = (F.substring(tail, -k, 1) for k in (4, 3, 2, 1))
    single = ((kind == "short") & (F.length(sn) == 8)) | ((kind == "long") & (F.length(tail) == 2)) | (kind == "unknown")
    half = F.substring(tail, -2, 2).isin("11", "12", "13", "14")
    order = lambda c: F.instr(F.lit(ROW_LETTERS), c)
    rows = F.when((order(a) > 0) & (order(b) > 0), order(b) - order(a)).otherwise(F.ascii(b) - F.ascii(a))
    digits = x0.rlike("^[0-9]$") & x1.rlike("^[0-9]$")
    cols = F.expr("0") + F.try_to_number(x1, F.lit("9")).cast("int") - F.try_to_number(x0, F.lit("9")).cast("int")
    one = F.lit(1.0)
    w = F.when(single, one).when(half, 0.5).when(digits, (cols + 1).cast("double")).otherwise(one)
    h = F.when(single, one).when(half, 0.5).when(digits, (rows + 1).cast("double")).otherwise(one)
    return w, h


def is_late(sn: Column) -> Column:
    """Short numbers of the later production; long numbers never are."""
    tail_bad = F.substring(sn, -4, 4).rlike(f"[{UNUSED_LETTERS}]")
    digits = F.substring(sn, 2, 5)
    number = F.when(digits.rlike("^[0-9]{5}$"), digits.cast("int"))
    first = _at(sn, 1)
    return F.when((name_type(sn) != "short") | tail_bad, False).when(number.isNull(), True).when(
        first.isin("A", "B", "C", "D"), number >= LATE_SMALL).when(first == "Y", number >= LATE_LARGE).otherwise(True)


def chip_size(spec: Column, margin: float = MARGIN) -> Column:
    """Edge length in pixels of a chip that is ``spec`` chips wide."""
    return F.floor(F.lit(FOV_EDGE) * (spec * FOVS_PER_CHIP + margin)).cast("long")


def kit_to_type(kit: Column, transcript_tag: str, protein_tag: str) -> Column:
    return (F.when(kit.contains(transcript_tag), "Transcriptomics")
            .when(kit.contains(protein_tag), "Protein").otherwise("UNKNOWN"))


def group_name(tag: Column, sn: Column, tech: Column, pattern: str = "IF") -> Column:
    """Group of an image: the tag without the serial number, or the technology."""
    join = lambda sep: F.btrim(F.array_join(F.split(tag, sep, -1) if isinstance(sep, str) else F.split(
        F.replace(tag, sep, F.lit("\u0001")), "\u0001", -1), "_"), F.lit("_"))
    tagged = tag.contains(pattern)
    return (F.when(tagged & tag.contains(sn), join(sn))
            .when(tagged, F.concat(join(pattern), F.lit(f"_{pattern}")))
            .when(tech == pattern, F.concat(tag, F.lit(f"_{pattern}"))).otherwise(tech))


def fov_scale(image_w: Column, image_h: Column, chip_w: Column, chip_h: Column) -> Column:
    """Mean of the ratios of long and of short sides."""
    return (F.greatest(image_w, image_h) / F.greatest(chip_w, chip_h)
            + F.least(image_w, image_h) / F.least(chip_w, chip_h)) / 2


def chip_grid(h: Column, w: Column, edge: int = 20000) -> tuple[Column, Column]:
    return F.floor(h / edge).cast("long"), F.floor(w / edge).cast("long")


def calibrated(dx: Column, dy: Column, thr: float = 20.0) -> Column:
    return F.hypot(dx, dy) <= thr
