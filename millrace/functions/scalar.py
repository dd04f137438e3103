"""Scalar expressions: coercion, clamping, paths, slugs and names (SF1-SF5, SF8-SF11, SF21, SF22, PF21). Templates: templates.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import rounded
from .templates import render as render

TRUE_WORDS, FALSE_WORDS = ("1", "true", "yes", "y", "on"), ("0", "false", "no", "n", "off")
COUNTER = "^(.+)_([0-9]{5})_$"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def non_blank(c: Column) -> Column:
    """Stripped; null if nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def first_of(*chain: Column) -> Column:
    """The first of an alias chain that isn't blank (PF19)."""
    return F.coalesce(*map(non_blank, chain))


def clamp(c: Column, low: float, high: float) -> Column:
    """SF1; NaN becomes null rather than the upper bound."""
    return F.when(~F.isnan(c), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def safe_float(c: Column, default: float | None) -> Column:
    """SF2: a number, or the default where the text is none; 1.0d and the like are no numbers."""
    text = strip(c.cast("string"))
    number = F.when(~text.rlike("[dDfF]$") | text.rlike("(?i)inf$"), text.try_cast("double"))
    return F.coalesce(number, F.lit(default).cast("double"))


def parse_bool(c: Column, default: bool = False) -> Column:
    """SF3: known words in any case; other texts are true unless they are empty, numbers unless they are 0; null is the default."""
    word = F.lower(strip(c.cast("string")))
    other = F.when(F.typeof(c) == "string", c.cast("string") != "").otherwise(F.coalesce(c.cast("string").try_cast("double") != 0, F.lit(True)))
    return F.when(c.isNull(), F.lit(default)).when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(other)


def image_extension(c: Column) -> Column:
    """SF4: lower case with a dot; .jpeg is .jpg; blank is null."""
    word = F.lower(non_blank(c))
    dotted = F.when(word.startswith("."), word).otherwise(F.concat(F.lit("."), word))
    return F.when(dotted == ".jpeg", ".jpg").otherwise(dotted)


def basename(c: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(c, "/+$", ""), "/"), -1)


def stem(c: Column) -> Column:
    """The name without its last suffix; a name that only has a leading dot keeps it."""
    return F.regexp_replace(basename(c), "(?<=.)\\.[^.]+$", "")


def suffix(c: Column) -> Column:
    return F.regexp_extract(basename(c), "^.+(\\.[^.]+)$", 1)


def slug(c: Column, default: str = "task") -> Column:
    """SF11."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9_.-]", "_"), "^[._-]+|[._-]+$", ""), F.lit("")), F.lit(default))


def output_prefix(name: Column) -> Column:
    """SF10: the prefix of prefix_00001_, null for other stems."""
    return F.nullif(F.regexp_extract(stem(name), COUNTER, 1), F.lit(""))


def output_counter(name: Column) -> Column:
    return F.regexp_extract(stem(name), COUNTER, 2).try_cast("int")


def ratio(n: Column, d: Column) -> Column:
    """SF21: 0 for an empty whole, else rounded half even to 4 places, on the exact value."""
    return F.when(d == 0, F.lit(0.0)).otherwise(rounded(n.cast("double") / d, 4))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """A number that is padded but never cut."""
    return F.format_string(f"{prefix}%0{width}d", number)


def filename_prefix(task: Column, service: Column, default: str = "ComfyUI") -> Column:
    """SF9: service_task, or the one of them that isn't blank, or the default."""
    return F.coalesce(F.nullif(F.concat_ws("_", non_blank(service), non_blank(task)), F.lit("")), F.lit(default))


def generation_mode(graph: Column, prefix: Column) -> Column:
    """PF21: by the graph's name, canny before flux_dev; else by the prefix of the file names."""
    name = F.lower(F.coalesce(graph, F.lit("")))
    plain = name.contains("flux_dev") | F.coalesce(prefix, F.lit("")).startswith("prompt_only")
    return F.when(name.contains("canny"), "prompt_canny").when(plain, "prompt_only").otherwise("unknown")


def augmentation(seed: Column) -> Column:
    """SF22: the parameters of an augmented copy, from a hash of its seed: struct of flip, degrees (within 8) and brightness (0.85 to 1.25)."""
    part = lambda name: F.pmod(F.xxhash64(seed, F.lit(name)), F.lit(1 << 20)) / float(1 << 20)
    return F.struct((part("flip") < 0.5).alias("flip"), (part("degrees") * 16 - 8).alias("degrees"), (0.85 + part("brightness") * 0.4).alias("brightness"))


def choice(options: list[str], salt: str, *key: Column) -> Column:
    """SF8: one of the options, the same for the same key; picked by a hash instead of a random sequence."""
    text = F.concat_ws("|", F.lit(salt), *(k.cast("string") for k in key))
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*map(F.lit, options)), (number % len(options) + 1).cast("int"))
