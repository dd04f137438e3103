"""Templates and draws against the standard library's."""

from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

from millrace.functions import draws as DR
from millrace.functions import templates as T


class Kept(dict):
    def __missing__(self, key):
        return "{" + key + "}"


def plain(template, values):
    return string.Template(template).safe_substitute(values).format_map(Kept(values))


ROWS = [("ab", "x y", "{b}"), ("it's", 'a "b" \\ c', "{a!r:>12}"), ("", "é\n\t\x01", "}}{{"), ("日本", "🎉z", "plain"), ("it's \"q\"", "\x7f\xa0", "{zz:^9}")]


@pytest.mark.parametrize("template", ["$a-${b} $$ $zz ${a}x$", "{a}|{b!r}|{zz}|{zz!r:>9}|{{a}}", "{a:>8}|{a:*^7}|{a:<6}|{a:.1}|{a:05}|{b!a}|{a!s:x>4.2s}", "$c and {a}", "{$a} {a:6}", "$c$c", "no fields", "", "{a:^}", "}}{{", "${a}{b:#<7}${c}"])
def test_templates(spark, template):
    rows = [r for r in ROWS if template != "{$a} {a:6}" or r[0].isalnum()]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string, c string")
    got = [r[0] for r in df.orderBy("k").select(T.render(template, {c: F.col(c) for c in "abc"})).collect()]
    assert got == [plain(template, dict(zip("abc", r, strict=True))) for r in rows]


def test_random_templates(spark):
    rng = random.Random(6)
    made = []
    while len(made) < 60:
        t = "".join(rng.choice(["$a", "${b}", "$$", "{a}", "{b!r}", "{zz}", "{c:>5}", "{a:_^6.2}", "{{", "}}", "text ", "${zz}", "$", "{b!a:9}"]) for _ in range(rng.randrange(1, 7)))
        made.append(t)
    df = spark.createDataFrame([("v1", "w 2", "{a}")], "a string, b string, c string")
    values = {"a": "v1", "b": "w 2", "c": "{a}"}
    got = df.select(*(T.render(t, {c: F.col(c) for c in "abc"}).alias(str(k)) for k, t in enumerate(made))).first()
    assert list(got) == [plain(t, values) for t in made]


def test_templates_that_are_wrong(spark):
    for bad in ("{a", "a}", "{}", "{a:=5}", "{a!x}", "{a[0]}"):
        with pytest.raises(ValueError):
            T.render(bad, {"a": F.lit("x")})
    with pytest.raises(Exception, match="no field"):
        spark.range(1).select(T.render("$a", {"a": F.lit("{open")})).collect()
    assert spark.range(1).select(T.render("<{a}>", {"a": F.lit(None).cast("string")})).first()[0] == "<>"


def test_prefixes(spark, tmp_path):
    df = spark.createDataFrame([("d/some.pic.png", "t", "s"), (None, None, "s"), (" ", " ", None)], "image_path string, task string, service string")
    context = {"seed": F.lit(5), "task_name": F.col("task"), "services_id": F.col("service"), **T.name_context(F.col("image_path"))}
    got = df.select(T.prefix_text("{anchor_image_stem}", context).alias("a"), T.prefix_text(None, context).alias("b"), T.prefix_text(None, context, " v ").alias("c"), T.prefix_text("{anchor_image_name_norm}-{seed:0>3}", context).alias("d")).collect()
    assert [tuple(r) for r in got] == [("some.pic", "s_t", "v", "some.pic.png-005"), ("s", "s", "v", "-005"), ("ComfyUI", "ComfyUI", "v", "-005")]
    (tmp_path / "t.txt").write_text("\n a {b}\n c \n")
    assert T.template_file(spark, str(tmp_path / "t.txt")) == "a {b}\n c"


def test_draws_of_many_seeds():
    """The first draws of 100,000 seeds, for lists of any size, and doubles."""
    import numpy as np

    rng = random.Random(1)
    seeds = np.array([0, 1, 2**32 - 1] + [rng.randrange(1 << 32) for _ in range(99_997)], np.int64)
    for k in range(0, len(seeds), 25_000):
        part = seeds[k : k + 25_000]
        t = DR.Twisters(part)
        got = list(zip(*(t.below(n).tolist() for n in (3, 1, 7, 16, 1000)), t.random().tolist(), strict=True))
        for s, g in zip(part.tolist(), got, strict=True):
            r = random.Random(s)
            assert g == (*(r.choice(range(n)) for n in (3, 1, 7, 16, 1000)), r.random())
    t = DR.Twisters(np.array([5]))
    r = random.Random(5)
    assert [int(t.words(np.array([0]))[0]) for _ in range(1400)] == [r.getrandbits(32) for _ in range(1400)]


def test_choices_and_augmentations(spark):
    import hashlib

    options = {"pose": ["sit", "stand", "run"], "fixed": "yes", "n": [1, 2, 3, 4, 5]}
    df = spark.range(200).select(F.col("id"), F.concat(F.lit("s"), "id").alias("sample_id"), F.lit(None).cast("string").alias("image_path"))
    made = DR.dynamic_choices(options, "salt", F.col("id"), F.col("id") + 9, F.col("sample_id"), F.col("image_path"))
    for row in df.select("id", *(c.alias(k) for k, c in made.items())).collect():
        key = f"salt|{row.id}|{row.id + 9}|s{row.id}|"
        r = random.Random(int(hashlib.sha256(key.encode()).hexdigest(), 16) & 0xFFFFFFFF)
        assert (row.pose, row.n, row.fixed) == (r.choice(options["pose"]), str(r.choice(options["n"])), "yes")
    with pytest.raises(ValueError):
        DR.dynamic_choices({"a": []}, "", *[F.lit(1)] * 4)
    for row in spark.range(300).select("id", DR.augmentations(F.when(F.col("id") != 7, F.col("id") * 7919)).alias("a")).collect():
        r = random.Random(row.id * 7919)
        if row.id == 7:
            assert row.a.flip is None and row.a.degrees is None
        else:
            assert tuple(row.a) == (r.random() > 0.5, r.uniform(-8.0, 8.0), 0.85 + r.random() * 0.4)
