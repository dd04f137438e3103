"""Queries over the driver's tables for every operator, and the same in SQL. Keys follow the operator inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import decimals as D
from .functions import scalar as S
from .functions import vision as V
from .operators import calibrate as C
from .operators import evaluate as E
from .operators import gate as G
from .operators import jobs as W
from .operators import labels as L
from .operators import manifests as M
from .operators import relational as R
from .sources import events as EV
from .sources import transaction as TX
from .sources import variants as VT
from .streaming import decisions, replay, stream_folder, window_counts
from .streaming import jobs as J

THRESHOLD = 0.25
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# margins and thresholds: the halves of a stored vector stand for positive and negative logits


def margins(spark, d):
    e = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", "label", V.margin(F.slice(e, 1, 32), F.slice(e, 33, 32), 3).alias("m")).select("vec_id", "label", "m.*")


MARGIN = """
e as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
p as (select vec_id, label, list_reverse_sort(v[1:32]) as a, list_reverse_sort(v[33:64]) as b from e),
m as (select vec_id, label, (a[1] + a[2] + a[3]) / 3 as pos_score, (b[1] + b[2] + b[3]) / 3 as neg_score,
  (a[1] + a[2] + a[3]) / 3 - (b[1] + b[2] + b[3]) / 3 as margin, cast(3 as int) as effective_k from p)"""


@query(f"with {MARGIN} select * from m")
def margin_topk(spark, d):
    """AG2, AG3."""
    return margins(spark, d)


@query(f"with {MARGIN} select vec_id, margin, case when margin >= {THRESHOLD} then 'accept' else 'reject' end as decision from m")
def margin_decision(spark, d):
    """PF4."""
    return margins(spark, d).select("vec_id", "margin", G.margin_decision(F.col("margin"), THRESHOLD).alias("decision"))


@query(f"with {MARGIN} select case when margin >= {THRESHOLD} then 'accept' else 'reject' end as decision, count(*) as n from m group by 1")
def margin_decision_counts(spark, d):
    """AG10."""
    return G.decision_counts(margin_decision(spark, d))


SWEEP = f"""{MARGIN},
s as (select margin as threshold, sum(label % 2) as pos, count(*) as n from m group by margin),
r as (select threshold, sum(pos) over w as tp, sum(n) over w as taken, sum(pos) over () as all_pos, sum(n) over () as all_n
  from s window w as (order by threshold desc rows between unbounded preceding and current row)),
c as (select threshold, cast(all_n - all_pos - taken + tp as bigint) as tn, cast(taken - tp as bigint) as fp, cast(all_pos - tp as bigint) as fn, cast(tp as bigint) as tp from r),
q as (select *, case when tp + fp > 0 then cast(tp as double) / (tp + fp) else 0.0 end as precision, case when tp + fn > 0 then cast(tp as double) / (tp + fn) else 0.0 end as recall from c),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0 end as f1 from q)"""


def swept(spark, d):
    return C.sweep(margins(spark, d).select("margin", (F.col("label") % 2).alias("label")))


@query(f"with {SWEEP} select * from f")
def sweep_candidates(spark, d):
    """AG4-AG6, AG9, WN1, SO7."""
    return swept(spark, d)


@query(f"with {SWEEP} select * from f order by f1 desc, recall desc, precision desc, threshold limit 1")
def best_f1(spark, d):
    """AG7."""
    return C.best_f1(swept(spark, d))


@query(f"with {SWEEP} select * from f where precision >= 0.5 order by recall desc, f1 desc, precision desc, threshold limit 1")
def best_at_min_precision(spark, d):
    """AG8."""
    return C.best_at_min_precision(swept(spark, d), 0.5)


# scalar functions


@query("select event_id, case when value > 50 then 50.0 when value < 5 then 5.0 else value end as clamped, coalesce(try_cast(event_type as double), -1.0) as number, event_type in ('view', 'click') as flag from events")
def clamp_safe_float(spark, d):
    """SF1-SF3."""
    word = F.when(F.col("event_type").isin("view", "click"), "Yes").otherwise(" off ")
    return table(spark, d, "events").select("event_id", S.clamp(F.col("value"), 5.0, 50.0).alias("clamped"), S.safe_float(F.col("event_type"), -1.0).alias("number"), S.parse_bool(word).alias("flag"))


@query(r"select page_id, regexp_replace(url, '/+$', '') as path, list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) as name, case when regexp_matches(list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1), '^.+\.[^.]+$') then regexp_extract(list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1), '^(.+)\.[^.]+$', 1) else list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) end as stem from pages")
def path_parts(spark, d):
    """SF5."""
    return table(spark, d, "pages").select("page_id", F.regexp_replace("url", "/+$", "").alias("path"), S.basename(F.col("url")).alias("name"), S.stem(F.col("url")).alias("stem"))


@query("select p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_name || ' #' || p_brand || '.', '[^a-zA-Z0-9_.-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'task') as slug from part")
def slug(spark, d):
    """SF11."""
    return table(spark, d, "part").select("p_partkey", S.slug(F.concat("p_name", F.lit(" #"), "p_brand", F.lit("."))).alias("slug"))


@query("select c_custkey, c_mktsegment as prefix, cast(c_custkey % 100000 as int) as counter from customer")
def output_counter(spark, d):
    """SF10."""
    name = F.concat("c_mktsegment", F.lit("_"), F.format_string("%05d", F.col("c_custkey") % 100000), F.lit("_.png"))
    return table(spark, d, "customer").select("c_custkey", S.output_prefix(name).alias("prefix"), S.output_counter(name).alias("counter"))


@query("select c_custkey, 'run_' || c_mktsegment || '_' || cast(c_nationkey as varchar) || '_{other}' as rendered, case when c_custkey % 2 = 0 then '.jpg' else '.png' end as ext from customer")
def templates(spark, d):
    """SF4, SF6."""
    ext = F.when(F.col("c_custkey") % 2 == 0, "JPEG").otherwise(" .png")
    return table(spark, d, "customer").select("c_custkey", S.render("run_${segment}_{nation}_{other}", {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}).alias("rendered"), S.image_extension(ext).alias("ext"))


@query("select o_orderkey, case cast(('0x' || substr(sha256('salt|' || cast(o_orderkey as varchar)), 1, 8)) as bigint) % 3 when 0 then 'a' when 1 then 'b' else 'c' end as choice from orders")
def dynamic_choice(spark, d):
    """SF8."""
    return table(spark, d, "orders").select("o_orderkey", S.choice(["a", "b", "c"], "salt", F.col("o_orderkey")).alias("choice"))


# gate: triples of a vector stand for keypoints, its first values for a box


def detections(spark, d):
    e = F.col("embedding").cast("array<double>")
    box = F.array(F.lit(0.0), F.lit(0.0), F.abs(F.get(e, F.lit(0))) * 200, F.abs(F.get(e, F.lit(1))) * 200)
    points = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda k: F.array(F.get(e, k * 3), F.get(e, k * 3 + 1), F.get(e, k * 3 + 2)))
    made = lambda score, b: F.struct(F.lit(1).alias("label"), score.alias("score"), b.alias("box"), points.alias("keypoints"))
    return table(spark, d, "embeddings").select("vec_id", e.alias("e"), made(F.get(e, F.lit(2)), box).alias("person"), made(F.get(e, F.lit(3)), box).alias("pose"))


DET = """
e as (select vec_id, cast(embedding as double[]) as v from embeddings),
g as (select vec_id, v, v[3] as person, v[4] as pose, (abs(v[1]) * 200) * (abs(v[2]) * 200) / 10000.0 as area,
  cast(len(list_filter(range(17), lambda k: v[k * 3 + 3] >= 0.05)) as int) as points from e),
h as (select *, person >= 0.0 as person_ok, pose >= 0.0 as pose_ok from g),
r as (select vec_id, area, case when pose_ok then points else 0 end as valid_keypoints, list_filter([
  case when not person_ok and not pose_ok then 'no_person_detected' end, case when area < 0.01 then 'bbox_too_small' end,
  case when area > 0.5 then 'bbox_too_large' end, case when pose_ok and points < 6 then 'insufficient_keypoints' end,
  case when not pose_ok then 'pose_missing' end], lambda x: x is not null) as reasons from h)"""


def gated(spark, d):
    gate = G.pose_gate(F.col("person"), F.col("pose"), F.lit(100), F.lit(100), min_score=0.0, min_keypoints=6, keypoint_threshold=0.05, min_area=0.01, max_area=0.5)
    return detections(spark, d).select("vec_id", gate.alias("g")).select("vec_id", "g.*")


ROUTES = {"no_person_detected": "reject", "bbox_too_small": "reject", "bbox_too_large": "reject", "insufficient_keypoints": "uncertain", "pose_missing": "uncertain"}
ROUTED = "case when len(reasons) = 0 then 'accept' when len(list_filter(reasons, lambda x: x not in ('insufficient_keypoints', 'pose_missing'))) = 0 then 'uncertain' else 'reject' end"


@query(f"with {DET} select vec_id, case when len(reasons) = 0 then 'accept' else 'reject' end as decision, array_to_string(reasons, ',') as reject_reasons, area as bbox_area_ratio, 'bbox' as roi_source, valid_keypoints from r")
def pose_gate(spark, d):
    """PF6, PF7, PF9."""
    return gated(spark, d).withColumn("reject_reasons", F.concat_ws(",", "reject_reasons"))


@query(f"with {DET} select vec_id, case when area < 0.01 or area > 0.5 or points < 6 then 'reject' else 'accept' end as decision, concat_ws(',', case when area < 0.01 then 'bbox_too_small' end, case when area > 0.5 then 'bbox_too_large' end, case when points < 6 then 'insufficient_keypoints' end) as reject_reasons, area as bbox_area_ratio, points as valid_keypoints from g")
def single_gate(spark, d):
    """PF10."""
    gate = G.single_gate(F.col("pose.box"), F.col("pose.keypoints"), F.lit(100), F.lit(100), min_keypoints=6, keypoint_threshold=0.05, min_area=0.01, max_area=0.5)
    return detections(spark, d).select("vec_id", gate.alias("g")).select("vec_id", "g.*").withColumn("reject_reasons", F.concat_ws(",", "reject_reasons"))


@query(f"with {DET} select {ROUTED} as decision, count(*) as n from r group by 1")
def route_counts(spark, d):
    """PF12, AG10."""
    return G.decision_counts(gated(spark, d).select(G.route(F.col("reject_reasons"), ROUTES).alias("decision")))


@query("""
with e as (select vec_id, unnest(cast(embedding as double[])) as x, unnest(range(64)) as place from embeddings),
r as (select vec_id, floor(x * 10) / 10 as score, place, row_number() over (partition by vec_id order by floor(x * 10) desc, place) as n from e where x >= 0 and place % 3 <> 0)
select v.vec_id, r.score, cast(r.place as int) as place from embeddings v left join r on r.vec_id = v.vec_id and r.n = 1""")
def best_detection(spark, d):
    """PF8: most scores have equals, of which the first counts; a third of the detections has another label."""
    found = F.transform("e", lambda x, k: F.struct(F.when(k % 3 == 0, 2).otherwise(1).alias("label"), (F.floor(x * 10) / 10).alias("score"), k.alias("place")))
    best = V.best_detection(found, 0.0)
    return detections(spark, d).select("vec_id", best["score"].alias("score"), best["place"].alias("place"))


# joins: orders stand for images, their lines for annotations


@query("select l_orderkey, count(*) as n_annotations from lineitem group by 1")
def coco_ann_count(spark, d):
    """SC8, AG11."""
    return R.annotation_counts(table(spark, d, "lineitem"), "l_orderkey")


@query("""
with i as (select o_orderkey, 'x/' || cast(o_orderkey % 7000 as varchar) || '.jpg' as image_path from orders),
c as (select o_custkey as id, cast(o_custkey as varchar) || case when o_custkey % 2 = 0 then '.jpg' else '.png' end as name, cast(o_custkey as varchar) as stem from orders group by 1),
a as (select o_custkey as id, count(*) as n from orders where o_orderstatus = 'F' group by 1),
m as (select i.*, coalesce(x.id, y.id) as id from i left join c x on x.name = string_split(i.image_path, '/')[2] left join c y on y.stem = string_split(string_split(i.image_path, '/')[2], '.')[1])
select m.o_orderkey, m.image_path, case when a.n > 0 then m.id end as coco_image_id, a.n as n_annotations from m left join a on a.id = m.id""")
def coco_resolve(spark, d):
    """JN1."""
    orders = table(spark, d, "orders")
    images = orders.select("o_orderkey", F.concat(F.lit("x/"), (F.col("o_orderkey") % 7000).cast("string"), F.lit(".jpg")).alias("image_path"))
    ids = orders.select(F.col("o_custkey").alias("id")).distinct()
    coco = ids.select("id", F.concat(F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, ".jpg").otherwise(".png")).alias("file_name"))
    counts = R.annotation_counts(orders.where("o_orderstatus = 'F'"), "o_custkey").withColumnRenamed("o_custkey", "image_id")
    return R.resolve_label(images, coco, counts)


@query("select l_orderkey, string_agg(cast(cast(l_quantity as int) as varchar), ',' order by l_linenumber, l_quantity, l_partkey, l_suppkey, l_extendedprice) as quantities from lineitem where l_linestatus = 'F' and l_quantity >= 10 and l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1")
def pose_collect(spark, d):
    """PF16, JN7, JN8, AG20."""
    images = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    order = F.struct("l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_extendedprice")
    got = R.group_annotations(table(spark, d, "lineitem"), images, "l_orderkey", (F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 10), F.col("l_quantity").cast("int"), order)
    return got.select("l_orderkey", F.concat_ws(",", F.transform("values", lambda x: x.cast("string"))).alias("quantities"))


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P' and o_custkey is not null)")
def missing_image(spark, d):
    """PF17, JN6."""
    return R.without_files(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("select l_orderkey from lineitem where l_returnflag = 'R' group by 1 having count(*) = 1")
def single_person_subset(spark, d):
    """OR13."""
    return R.single_only(table(spark, d, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R")


@query("select 'required' as mode, d.doc_id, l.quality from documents d join labels l using (doc_id) where l.quality is not null union all select 'optional', d.doc_id, l.quality from documents d left join labels l using (doc_id)")
def require_labels(spark, d):
    """PF18, JN2: where labels are required, and where they are not."""
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id", "quality")
    both = [R.labelled(docs, labels, ["doc_id"], "quality", required).select(F.lit(mode).alias("mode"), "doc_id", "quality") for mode, required in (("required", True), ("optional", False))]
    return both[0].unionByName(both[1])


# splits, unions and numbers

SPLIT = "select doc_id, row_number() over (order by md5('{seed}:' || cast(doc_id as varchar)), doc_id) as r, count(*) over () as n from {rows}"


@query(f"select doc_id, case when r <= greatest(1, floor(n * 0.2)) then 'val' else 'train' end as split from ({SPLIT.format(seed=42, rows='documents')})")
def split_train_val(spark, d):
    """SO4."""
    return R.split_train_val(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2, 42)


@query(f"with a as ({SPLIT.format(seed=42, rows='documents')}), b as ({SPLIT.format(seed=43, rows='(select doc_id from a where r > 100)')}) select doc_id, 'test' as split from a where r <= 100 union all select doc_id, case when r <= greatest(1, floor(n * 0.15)) then 'val' else 'train' end from b")
def split_holdout(spark, d):
    """SO5, SO6."""
    return R.split_with_holdout(table(spark, d, "documents").select("doc_id"), "doc_id", 0.15, 42, test_count=100)


@query("select 'real_' || c_name as name, 'train' as split from customer where c_nationkey % 2 = 0 union all select 'synth_' || s_name, 'train' from supplier where s_nationkey % 2 = 0 union all select p_name, 'val' from part where p_size > 45")
def mixed_union(spark, d):
    """SO2, SO3."""
    split = lambda c: F.when(F.col(c) % 2 == 0, "train").otherwise("val").alias("split")
    real, synthetic = table(spark, d, "customer").select(F.col("c_name").alias("name"), split("c_nationkey")), table(spark, d, "supplier").select(F.col("s_name").alias("name"), split("s_nationkey"))
    return R.mixed_dataset(real, synthetic, table(spark, d, "part").where("p_size > 45").select(F.col("p_name").alias("name")))


@query("select c_custkey as id, c_name as name, cast(null as double) as balance, 0 as _file from customer union all select s_suppkey, s_name, s_acctbal, 1 from supplier")
def manifest_union(spark, d):
    """SO1, SC10."""
    return R.union_manifests(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))).select("id", "name", "balance", "_file")


@query("select o_orderkey, printf('row_%07d', row_number() over (order by o_orderkey) - 1) as generated_id from orders where o_orderstatus = 'F'")
def seq_ids(spark, d):
    """WN2, WN3, PF1, PF2."""
    return R.numbered(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey"), [F.col("o_orderkey")], "row_", 7)


# lineage and jobs


@query("select c.c_nationkey, c.c_custkey, m.ref_id, m.candidates from customer c join (select s_nationkey, arg_min(s_suppkey, s_acctbal * 1000000 + s_suppkey) as ref_id, count(*) as candidates from supplier group by 1) m on m.s_nationkey = c.c_nationkey")
def exact_match(spark, d):
    """JN4."""
    refs = table(spark, d, "supplier").select(F.col("s_nationkey").alias("name"), F.col("s_suppkey").alias("ref_id"), (F.col("s_acctbal") * 1000000 + F.col("s_suppkey")).alias("pos"))
    return R.exact_matches(table(spark, d, "customer").select(F.col("c_nationkey").alias("name"), "c_custkey"), refs).select(F.col("name").alias("c_nationkey"), "c_custkey", "ref_id", "candidates")


@query("with f as (select c_nationkey as prefix, c_name as name, row_number() over (partition by c_nationkey order by c_custkey, c_name) as t from customer), r as (select s_nationkey as prefix, s_suppkey as ref_id, row_number() over (partition by s_nationkey order by s_suppkey) as t from supplier) select f.prefix, f.name, r.ref_id from f join r on r.prefix = f.prefix and r.t = f.t")
def prefix_pairing(spark, d):
    """JN5, WN4."""
    files = table(spark, d, "customer").select(F.col("c_nationkey").alias("prefix"), F.col("c_name").alias("name"), F.col("c_custkey").alias("counter"))
    return R.rank_pairs(files, table(spark, d, "supplier").select(F.col("s_nationkey").alias("prefix"), F.col("s_suppkey").alias("ref_id"))).select("prefix", "name", "ref_id")


@query("with g as (select o_custkey as prefix, o_orderpriority as run, count(*) as n from orders group by 1, 2) select prefix, run from (select *, row_number() over (partition by prefix order by n desc, run desc) as t from g) where t = 1")
def run_group(spark, d):
    """AG18."""
    return R.chosen_runs(table(spark, d, "orders").select(F.col("o_custkey").alias("prefix"), F.col("o_orderpriority").alias("run"), F.col("o_orderpriority").alias("run_order")))


DIMS = """
r as (select o_custkey, cast(o_orderkey % 4 as int) as w, cast(o_orderkey % 3 as int) as h, row_number() over (partition by o_custkey order by o_orderkey desc) as t from orders),
s as (select c_custkey as guide_image_id, cast(c_custkey % 4 as int) as width, cast(c_custkey % 3 as int) as height, r.w as anchor_width, r.h as anchor_height, r.w = cast(c_custkey % 4 as int) and r.h = cast(c_custkey % 3 as int) as size_match_anchor from customer left join r on r.o_custkey = c_custkey and r.t = 1)"""


def dimensioned(spark, d):
    size = lambda c, w, h: ((F.col(c) % 4).cast("int").alias(w), (F.col(c) % 3).cast("int").alias(h))
    real = table(spark, d, "orders").select(F.col("o_custkey").alias("sample_id"), *size("o_orderkey", "width", "height"), F.col("o_orderkey").alias("pos"))
    return R.dimensions(table(spark, d, "customer").select(F.col("c_custkey").alias("guide_image_id"), *size("c_custkey", "width", "height")), real)


@query(f"with {DIMS} select * from s")
def dims_enrich(spark, d):
    """JN3."""
    return dimensioned(spark, d)


@query(f"with {DIMS} select count(size_match_anchor) as checked, count(*) filter (where size_match_anchor) as matching, count(*) filter (where not size_match_anchor) as differing from s")
def dims_counts(spark, d):
    """JN3: the counters."""
    return R.size_counts(dimensioned(spark, d))


@query("select count(distinct nullif(trim(event_type), '')) as jobs from events")
def job_count(spark, d):
    """AG17."""
    return R.job_count(table(spark, d, "events"), "event_type")


@query("select j as job, s.s_suppkey as anchor_id, j + 1000 as seed from range(500) t(j) join (select s_suppkey, row_number() over (order by s_suppkey) - 1 as k, count(*) over () as n from supplier) s on s.k = j % s.n")
def job_plan(spark, d):
    """JN9, WN5."""
    anchors = R.ranked(table(spark, d, "supplier").select(F.col("s_suppkey").alias("anchor_id")), "anchor_id", [F.col("anchor_id")])
    return R.job_plan(anchors.select("anchor_id", (F.col("rank") - 1).alias("turn")), 500, 1000)


@query("select c_custkey as sample_id, k as k, 7 + c_custkey * 100 + k as seed from customer, (select cast(unnest(range(3)) as int) as k) order by c_custkey, k limit 1000")
def local_stub_plan(spark, d):
    """JN10, SL3."""
    real = table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_custkey").alias("pos"))
    return R.stub_plan(real, 3, 7, 1000).select("sample_id", "k", "seed")


@query("select p_partkey, concat_ws(',', case when p_size > 30 then 'width>30' end, case when p_size * 2 > 80 then 'height>80' end, case when greatest(p_size, p_size * 2) > 90 then 'long_edge>90' end) as reason from part")
def anchor_filter(spark, d):
    """PF15."""
    return table(spark, d, "part").select("p_partkey", G.size_reasons(F.col("p_size"), F.col("p_size") * 2, max_width=30, max_height=80, max_long_edge=90).alias("reason"))


# labels


@query("select c_custkey as task_id, o_orderkey as annotation_id, o_orderstatus as status, o_orderkey is not null as has_annotation from customer left join orders on o_custkey = c_custkey")
def flatten_annotations(spark, d):
    """SF17: customers stand for tasks, their orders for annotations; a third has none."""
    from .sources import flatten_annotations as flatten

    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("annotations"))
    tasks = table(spark, d, "customer").select(F.col("c_custkey").alias("id")).join(orders, "id", "left")
    return flatten(tasks).select("task_id", F.col("annotation.o_orderkey").alias("annotation_id"), F.col("annotation.o_orderstatus").alias("status"), "has_annotation")


@query("select vec_id, cast(case when x >= 0.5 then 2 when x > 0 then 1 else 0 end as int) as visibility from (select vec_id, cast(embedding[1] as double) * 5 as x from embeddings)")
def visibility(spark, d):
    """SF13."""
    return table(spark, d, "embeddings").select("vec_id", V.visibility(F.get("embedding", F.lit(0)).cast("double") * 5, 0.5).alias("visibility"))


# reports


@query("with s as (select case when s_nationkey % 2 = 0 then 'real' else 'synthetic' end as source, s_acctbal as score from supplier) select count(*) as total, count(*) filter (where source = 'real') as real, count(*) filter (where source = 'synthetic') as synthetic, cast(printf('%.4f', count(*) filter (where source = 'real') / count(*)) as double) as real_ratio, cast(printf('%.4f', count(*) filter (where source = 'synthetic') / count(*)) as double) as synthetic_ratio from s")
def mix_report(spark, d):
    """AG15, SF21."""
    rows = table(spark, d, "supplier").select(F.when(F.col("s_nationkey") % 2 == 0, "real").otherwise("synthetic").alias("source"))
    return E.mix_report(rows)


@query("select cast(s_suppkey as varchar) as sample_id, 'real' as source, 'low_asf_score' as reason, s_acctbal as score from supplier order by s_acctbal, s_suppkey limit 5")
def hard_cases(spark, d):
    """SL1, PF22."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sample_id"), F.lit("real").alias("source"), F.col("s_acctbal").alias("score"), F.col("s_suppkey").alias("pos"))
    return E.hard_cases(rows)


@query("select avg(p_size) as mean_width, avg(p_size * 2) as mean_height, min(p_size) as min_width, max(p_size) as max_width, min(p_size * 2) as min_height, max(p_size * 2) as max_height, count(*) filter (where p_size > 10) as with_label, count(*) filter (where p_size <= 10) as without_label from part")
def resolution_stats(spark, d):
    """AG12."""
    rows = table(spark, d, "part").select(F.col("p_size").alias("width"), (F.col("p_size") * 2).alias("height"), F.when(F.col("p_size") > 10, "x").alias("label"))
    return E.resolution_stats(rows)


@query("select o_orderpriority, case when count(*) filter (where o_orderstatus = 'F') < count(*) * 0.5 then 'tighten_filter' else 'relax_filter' end as action, cast(case when count(*) filter (where o_orderstatus = 'F') < count(*) * 0.5 then 0.65 else 0.57 end as double) as next_threshold from orders group by 1")
def policy_feedback(spark, d):
    """AG23, AG24."""
    share = table(spark, d, "orders").groupBy("o_orderpriority").agg((F.count(F.when(F.col("o_orderstatus") == "F", 1)) / F.count(F.lit(1))).alias("v"))
    return share.select("o_orderpriority", E.policy(F.col("v"), 0.5, F.lit(0.6)).alias("p")).select("o_orderpriority", "p.*")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_stems(spark, d):
    """AG22."""
    rows = table(spark, d, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("stem"))
    return R.duplicated(rows, "stem").select("stem.l_orderkey", "stem.l_linenumber", "n")


# manifests

MANIFESTS = """
m as (select case when c_custkey % 3 = 0 then '  ' else 'c' || c_custkey end as sample_id, case when c_custkey % 2 = 0 then ' s/' || c_name || ' ' end as synthetic_image_path, 'p/' || c_name as image_path, c_custkey as pos, 0 as _file from customer
  union all select case when s_suppkey % 2 = 0 then 's' || s_suppkey end, null, 'q/' || s_name, s_suppkey, 1 from supplier),
n as (select *, row_number() over (partition by _file order by pos) - 1 as own, row_number() over (order by _file, pos) - 1 as whole from m)"""


def manifests(spark, d):
    first = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.concat(F.lit("c"), "c_custkey")).alias("sample_id"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" s/"), "c_name", F.lit(" "))).alias("synthetic_image_path"), F.concat(F.lit("p/"), "c_name").alias("image_path"), F.col("c_custkey").alias("pos"))
    second = table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("s"), "s_suppkey")).alias("sample_id"), F.concat(F.lit("q/"), "s_name").alias("image_path"), F.col("s_suppkey").alias("pos"))
    return R.union_manifests(first, second)


@query(f"with {MANIFESTS} select coalesce(nullif(trim(sample_id), ''), printf('row_%07d', own)) as sample_id, coalesce(nullif(trim(synthetic_image_path), ''), image_path) as image_path from n")
def filter_inputs(spark, d):
    """PF1, SC10, SO1: ids by the place within each file."""
    return M.filter_inputs(manifests(spark, d), "pos", "_file")


@query(f"with {MANIFESTS} select coalesce(nullif(trim(sample_id), ''), printf('row_%07d', whole)) as sample_id, image_path, pos as raw_pos from n")
def filter_rows(spark, d):
    """PF2, PF3: ids by the place in all rows, and the row itself."""
    rows = manifests(spark, d).withColumn("turn", F.struct("_file", "pos"))
    return M.filter_inputs(rows, "turn", raw=True, paths=("image_path", "imagepath", "path")).select("sample_id", "image_path", F.col("raw.pos").alias("raw_pos"))


@query(f"with {MANIFESTS} select coalesce(nullif(trim(sample_id), ''), regexp_replace(string_split(image_path, '/')[2], '(.)[.][^.]+$', '\\1')) as sample_id, image_path as path from m")
def aliases(spark, d):
    """PF19."""
    rows = manifests(spark, d)
    return rows.select(M.sample_id(rows).alias("sample_id"), M.image_path(rows).alias("path"))


@query("""
select 'g' || o_orderkey as synthetic_id, 'o' || o_orderkey || '.png' as synthetic_image_name, 'd/o' || o_orderkey || '.png' as synthetic_image_path, 640 as width, 480 as height,
  case when o_orderkey % 3 = 0 then 'effective' when o_orderkey % 3 = 1 then 'own' else 'default' end as prompt_text, o_orderkey as seed,
  case when o_orderkey % 2 = 0 then 'a' || o_custkey else '' end as guide_image_id, 'image_guided' as guide_type,
  case when o_orderstatus = 'F' then 'flux_canny.json' else 'ref' end as config_ref, 'g' || o_orderkey as ids from orders""")
def trace_rows(spark, d):
    """PF20."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.concat(F.lit("g"), k).alias("sample_id"), F.concat(F.lit("d/o"), k, F.lit(".png")).alias("image_path"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.when(k % 3 == 0, " effective ").alias("effective_prompt_text"), F.when(k % 3 <= 1, "own").otherwise(" ").alias("prompt_text"), k.alias("seed"), F.lit(" ").alias("guide_image_id"), F.when(k % 2 == 0, F.concat(F.lit("a"), "o_custkey")).alias("anchor_real_sample_id"), F.when(F.col("o_orderstatus") == "F", "flux_canny.json").alias("comfy_prompt_graph_source"), F.lit(None).cast("array<string>").alias("synthetic_image_ids"))
    return M.trace_rows(rows, "ref", "image_guided", "default").withColumn("ids", F.concat_ws(",", "synthetic_image_ids")).drop("synthetic_image_ids")


@query("select o_orderkey, case when o_orderstatus = 'F' then 'prompt_canny' when o_orderstatus = 'O' or o_orderkey % 2 = 0 then 'prompt_only' else 'unknown' end as mode from orders")
def generation_mode(spark, d):
    """PF21."""
    graph = F.when(F.col("o_orderstatus") == "F", "x/Flux_Dev_CANNY.json").when(F.col("o_orderstatus") == "O", "FLUX_dev.json")
    prefix = F.when(F.col("o_orderkey") % 2 == 0, "prompt_only_1").otherwise("other")
    return table(spark, d, "orders").select("o_orderkey", S.generation_mode(graph, prefix).alias("mode"))


CLEAN = """
f as (select c_custkey, c_mktsegment as seg, c_mktsegment || '_' || lpad(cast(c_custkey as varchar), 5, '0') || '_.png' as output_filename from customer),
r as (select o_orderkey as pos, 'r' || o_orderkey % 3 as run_id, o_orderkey % 3 as run_order, 'm/' || o_orderkey % 3 as manifest_path, 'g' || o_orderkey as sample_id,
  case when o_orderkey % 16 = 0 then output_filename else 'ComfyUI_temp_' || o_orderkey || '.png' end as comfy_filename,
  case when o_orderkey % 7 = 0 then seg end as effective_filename_prefix, case when o_orderstatus = 'F' then 'x/canny.json' end as graph, case when o_orderkey % 5 = 0 then 'a' || o_custkey end as guide
  from orders join f on f.c_custkey = o_custkey),
e as (select comfy_filename as output_filename, arg_min(sample_id, pos) as ref, count(*) as candidates from r group by 1),
x as (select f.*, e.ref, e.candidates from f left join e using (output_filename)),
t as (select * from r where comfy_filename like 'ComfyUI_temp_%' and effective_filename_prefix is not null),
n as (select effective_filename_prefix as seg, run_id, run_order, count(*) as n from t group by 1, 2, 3),
b as (select seg, arg_max(run_id, n * 10 + run_order) as run_id, count(*) as candidates from n group by 1),
q as (select t.*, b.seg, b.candidates, row_number() over (partition by b.seg order by sample_id, pos) as turn from t join b on b.seg = t.effective_filename_prefix and b.run_id = t.run_id),
u as (select output_filename, seg, row_number() over (partition by seg order by c_custkey) as turn from x where ref is null),
m as (select output_filename, ref, 'exact_comfy_filename' as method, candidates from x where ref is not null
  union all select u.output_filename, q.sample_id, case when q.sample_id is null then '' else 'prefix_fallback' end, coalesce(q.candidates, 0) from u left join q on q.seg = u.seg and q.turn = u.turn),
c as (select regexp_replace(output_filename, '.png$', '') as sample_id, 'synthetic' as source, 'out/' || output_filename as image_path, case when ref is null then 'no_reference' else 'matched' end as map_status,
  method as map_method, cast(m.candidates as bigint) as map_ambiguous_candidates, output_filename, case when ref is null then '' else r.run_id end as reference_run_id, coalesce(ref, '') as reference_sample_id,
  case when ref is null then '' else r.manifest_path end as reference_manifest_path, case when r.graph is not null then 'prompt_canny' else 'unknown' end as generation_mode, coalesce(r.guide, '') as guide_image_id,
  case when ref is null then '' end as anchor_real_image_path, r.guide is not null as guided_by_real, case when ref is null then '' else r.effective_filename_prefix end as effective_filename_prefix,
  case when ref is null then '' else r.comfy_filename end as comfy_filename_ref from m left join r on r.sample_id = m.ref)"""


def references(spark, d):
    name = F.concat("c_mktsegment", F.lit("_"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"), F.lit("_.png"))
    files = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("seg"), name.alias("output_filename"))
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    rows = table(spark, d, "orders").join(files, F.col("o_custkey") == F.col("c_custkey")).select(k.alias("pos"), F.concat(F.lit("r"), k % 3).alias("run_id"), (k % 3).alias("run_order"), F.concat(F.lit("m/"), k % 3).alias("manifest_path"), F.concat(F.lit("g"), k).alias("sample_id"), F.when(k % 16 == 0, F.col("output_filename")).otherwise(F.concat(F.lit("ComfyUI_temp_"), k, F.lit(".png"))).alias("comfy_filename"), none.alias("comfy_type"), F.when(k % 7 == 0, F.col("seg")).alias("effective_filename_prefix"), F.when(F.col("o_orderstatus") == "F", "x/canny.json").alias("comfy_prompt_graph_source"), F.when(k % 5 == 0, F.concat(F.lit("a"), "o_custkey")).alias("guide_image_id"), none.alias("anchor_real_sample_id"), none.alias("anchor_real_image_path"))
    return files.select("output_filename", F.col("c_custkey").alias("turn")), rows


@query(f"with {CLEAN} select * from c")
def clean_manifest(spark, d):
    """JN4-JN6, AG18, PF21, SL4: the whole matching of output files and generated rows."""
    return M.clean_manifest(*references(spark, d), "out")


@query(f"with {CLEAN} select count(*) as output_image_count, count(*) filter (where map_method = 'exact_comfy_filename') as matched_exact_count, count(*) filter (where map_method = 'prefix_fallback') as matched_prefix_count, count(*) filter (where map_status = 'no_reference') as no_reference_count, count(*) filter (where map_method = 'exact_comfy_filename' and map_ambiguous_candidates > 1) as ambiguous_exact_filename_count, count(distinct effective_filename_prefix) filter (where map_method = 'prefix_fallback' and map_ambiguous_candidates > 1) as ambiguous_prefix_count, count(*) filter (where map_status = 'matched') as matched_total_count, (select count(*) from r) as reference_row_count, cast(3 as int) as reference_manifest_count from c")
def clean_summary(spark, d):
    """AG19."""
    files, rows = references(spark, d)
    return M.clean_summary(M.clean_manifest(files, rows, "out"), rows, 3)


@query("select cast(floor(count(*) / 2) as bigint) as copied from lineitem where l_returnflag in ('A', 'R')")
def copied_files(spark, d):
    """AG21."""
    kind = F.when(F.col("l_returnflag") == "A", "images").when(F.col("l_returnflag") == "R", "labels").otherwise("other")
    return R.copied(table(spark, d, "lineitem").select(kind.alias("kind")))


@query("with r as (select o_custkey, min(o_orderkey) as pos, max(o_orderkey) as k from orders group by 1) select r.o_custkey, pos, o_orderstatus, o_totalprice from r join orders o on o.o_orderkey = r.k")
def last_rows(spark, d):
    """AG25, WN6."""
    return R.last_rows(table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("pos"), "o_orderstatus", "o_totalprice"), "o_custkey", "pos")


@query("select o_orderkey from orders order by o_totalprice, o_orderkey limit 77")
def limited_rows(spark, d):
    """SL2, SL3, SL5."""
    return R.limited(table(spark, d, "orders"), 77, "o_totalprice", "o_orderkey").select("o_orderkey")


@query("select c_custkey as c_custkey, c_custkey % 5 as n, case when c_custkey % 5 = 0 then null else cast(to_json({'image': 'i/' || c_name}) as varchar) end as data from customer where c_custkey % 5 <> 0")
def import_tasks(spark, d):
    """SK13."""
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 5).alias("n"), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("i/"), "c_name")).otherwise(" ").alias("image_url"))
    return M.import_tasks(rows).select("meta.c_custkey", "meta.n", F.to_json("data").alias("data"))


@query("select cast(o_orderkey as varchar) as prompt_id, cast(l_partkey as varchar) as sample_id, 'out/sub/' || l_partkey || '.png' as image_path, 'synthetic' as source, 'comfyui' as generation_backend, cast(l_linenumber as varchar) as comfy_node_id, l_partkey || '.png' as comfy_filename, 'sub' as comfy_subfolder, 'output' as comfy_type from (select distinct o_orderkey, l_linenumber, max(l_partkey) over (partition by o_orderkey, l_linenumber) as l_partkey from orders join lineitem on l_orderkey = o_orderkey) where l_partkey in (select p_partkey from part where p_size > 25)")
def history_outputs(spark, d):
    """SC15: orders stand for jobs, their lines for nodes."""
    image = F.array(F.struct(F.concat("l_partkey", F.lit(".png")).alias("filename"), F.lit("sub").alias("subfolder"), F.lit("output").alias("type")), F.struct(F.lit("x.png").alias("filename"), F.lit("sub").alias("subfolder"), F.lit("temp").alias("type")))
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("l_partkey"))
    nodes = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("l_linenumber").cast("string"), image))).alias("outputs"))
    jobs = table(spark, d, "orders").join(nodes, "o_orderkey").select(F.col("o_orderkey").cast("string").alias("prompt_id"), "outputs")
    return M.history_outputs(jobs, table(spark, d, "part").where("p_size > 25").select(F.concat(F.lit("out/sub/"), "p_partkey", F.lit(".png")).alias("path")), "out")


@query("select cast(o_orderkey as varchar) as prompt_id from orders where o_orderstatus = 'F' and o_orderkey % 2 = 0")
def finished_jobs(spark, d):
    """SC14: orders stand for messages of a service."""
    kind = F.when(F.col("o_orderkey") % 2 == 0, "executing").otherwise("progress")
    data = F.struct(F.when(F.col("o_orderstatus") != "F", "7").alias("node"), F.col("o_orderkey").cast("string").alias("prompt_id"))
    return M.finished_jobs(table(spark, d, "orders").select(F.to_json(F.struct(kind.alias("type"), data.alias("data"))).alias("message")))


# settings of names, prompts and graphs


@query("select c_custkey, case when c_custkey % 4 = 0 then 'ComfyUI' when c_custkey % 4 = 1 then 's_t' when c_custkey % 4 = 2 then 't' else 's' end as prefix from customer")
def filename_prefix(spark, d):
    """SF9."""
    k = F.col("c_custkey") % 4
    return table(spark, d, "customer").select("c_custkey", S.filename_prefix(F.when(k.isin(1, 2), " t "), F.when(k.isin(1, 3), "s").otherwise(" ")).alias("prefix"))


@query("select c_custkey, 'a ' || c_mktsegment || ' no ' || c_custkey || ' seed ' || (c_custkey + 5) || ' {unknown} ' || c_mktsegment as text from customer")
def prompt_text(spark, d):
    """SF6, SF7: a chosen word may name another field."""
    from .functions.graphs import prompt_text as text

    made = text("a $style no ${sample_index} seed {seed} {unknown} $other", {"style": F.lit("not this"), "segment": F.col("c_mktsegment")}, {"style": F.col("c_mktsegment"), "other": F.lit("{segment}")}, F.col("c_custkey"), F.col("c_custkey") + 5)
    return table(spark, d, "customer").select("c_custkey", made.alias("text"))


@query("select c_custkey, c_custkey % 3 = 0 as api, c_custkey % 3 = 1 as ui, case when c_custkey % 3 = 0 then c_custkey end as seed from customer")
def prompt_graphs(spark, d):
    """SF18, SF19."""
    from .functions import graphs

    k = F.col("c_custkey")
    graph = F.when(k % 3 == 0, '{"3": {"class_type": "K", "inputs": {"seed": 1, "model": ["4", 0]}}}').when(k % 3 == 1, '{"nodes": [], "links": [], "last_node_id": 4}').otherwise('{"3": 1}')
    rows = table(spark, d, "customer").select("c_custkey", graph.alias("g")).select("c_custkey", "g", graphs.is_api_graph(F.col("g")).alias("api"), graphs.is_ui_graph(F.col("g")).alias("ui"))
    patched = graphs.with_inputs(F.when(F.col("api"), F.col("g")), {("3", "seed"): k})
    return rows.select("c_custkey", "api", "ui", F.get_json_object(patched, "$.3.inputs.seed").cast("long").alias("seed"))


@query("select c_custkey, case when c_custkey % 2 = 0 then '/near/' || c_name when c_custkey % 3 = 0 then '/far/' || c_name else '/near/' || c_name end as image_path from customer")
def resolved_paths(spark, d):
    """SC11."""
    from .sources.files import resolved_paths as resolve

    rows = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("image_path"))
    place = F.when(F.col("c_custkey") % 2 == 0, "/near/").when(F.col("c_custkey") % 3 == 0, "/far/").otherwise("/else/")
    return resolve(rows, table(spark, d, "customer").select(F.concat(place, "c_name").alias("path")), "/near", "/far")


@query("select c_custkey, case when c_custkey % 2 = 0 then 'd/' || c_name || '.png' end as image_path from customer")
def images_by_name(spark, d):
    """SC16."""
    from .sources.files import images_by_name as find

    name = F.concat("c_name", F.lit(".png"))
    files = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("d/"), name).alias("path"))
    return find(table(spark, d, "customer").select("c_custkey", F.concat(F.lit("http://x/y/"), name).alias("image")), files).select("c_custkey", "image_path")


# failing rows, sizes and labels


@query("""
select vec_id, case when vec_id % 5 = 0 or vec_id % 7 = 0 or vec_id % 11 = 0 then 'reject' when area < 0.3 then 'reject' when points < 6 then 'uncertain' else 'accept' end as decision,
  case when vec_id % 5 = 0 or vec_id % 7 = 0 or vec_id % 11 = 0 then 'none' else 'segmentation' end as roi_source,
  case when vec_id % 5 = 0 or vec_id % 7 = 0 or vec_id % 11 = 0 then 0.0 else area end as bbox_area_ratio,
  case when vec_id % 5 = 0 or vec_id % 7 = 0 or vec_id % 11 = 0 then 0.0 else cast(0.9 as double) end as pose_score,
  cast(case when vec_id % 5 = 0 or vec_id % 7 = 0 or vec_id % 11 = 0 then 0 else points end as int) as valid_keypoints,
  case when vec_id % 5 = 0 then 'image_read_error' when vec_id % 7 = 0 then 'pose_inference_error' when vec_id % 11 = 0 then 'detection_inference_error'
    else concat_ws(',', case when area < 0.3 then 'bbox_too_small' end, case when points < 6 then 'insufficient_keypoints' end) end as reject_reasons
from (select vec_id, least(greatest(cast(embedding[5] as double) * 4, 0.0), 1.0) as area, len(list_filter(range(17), lambda k: cast(embedding[k * 3 + 3] as double) >= 0.05)) as points from embeddings)""")
def gated_rows(spark, d):
    """PF11, PF13: errors before the gate, and areas that come before the box."""
    k = F.col("vec_id")
    error = lambda n: F.when(k % n == 0, "broken")
    pose = F.struct(F.lit(1).alias("label"), F.lit(0.9).alias("score"), F.array().cast("array<double>").alias("box"), F.col("pose.keypoints").alias("keypoints"))
    rows = detections(spark, d).select("vec_id", k.alias("sample_id"), F.lit("p").alias("image_path"), F.lit(100).alias("width"), F.lit(100).alias("height"), F.lit(None).cast("struct<label:int,score:double,box:array<double>,keypoints:array<array<double>>>").alias("person"), pose.alias("pose"), (F.get("e", F.lit(4)) * 4).cast("string").alias("area"), error(5).alias("image_error"), error(7).alias("pose_error"), error(11).alias("detection_error"))
    found = G.gated_rows(rows, ROUTES, min_score=0.0, min_keypoints=6, keypoint_threshold=0.05, min_area=0.3)
    return found.select(F.col("sample_id").alias("vec_id"), "decision", "roi_source", "bbox_area_ratio", "pose_score", "valid_keypoints", F.concat_ws(",", "reject_reasons").alias("reject_reasons"))


ANCHORS = "a as (select p_partkey, case when p_partkey % 10 = 0 then 'missing_path_field:image_path' when p_partkey % 10 = 1 then 'missing_file' else concat_ws(',', case when p_size > 30 then 'width>30' end, case when p_size * 2 > 80 then 'height>80' end) end as reason from part)"


def anchored(spark, d):
    path = F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("f/"), "p_partkey")).otherwise(" ")
    rows = table(spark, d, "part").select("p_partkey", path.alias("image_path"), F.col("p_size").alias("width"), (F.col("p_size") * 2).alias("height"))
    files = table(spark, d, "part").where("p_partkey % 10 > 1").select(F.concat(F.lit("f/"), "p_partkey").alias("path"))
    return G.anchors_by_size(rows, files, "image_path", max_width=30, max_height=80)


@query(f"with {ANCHORS} select * from a")
def anchor_reasons(spark, d):
    """PF15: with the files and paths that are missing."""
    return anchored(spark, d).select("p_partkey", "reason")


@query(f"with {ANCHORS} select count(*) as total, count(*) filter (where reason = '') as kept, count(*) filter (where reason = 'missing_file') as missing_file, count(*) filter (where reason like 'missing_path%') as missing_path_field, count(*) filter (where reason like '%>%') as too_large from a")
def anchor_stats(spark, d):
    """PF15: the counters."""
    return G.anchor_stats(anchored(spark, d))


@query("select vec_id, cast(len(list_filter(range(21), lambda k: embedding[k * 3 + 3] > 0)) as int) as visible from embeddings")
def visible_keypoints(spark, d):
    """SF16."""
    return table(spark, d, "embeddings").select("vec_id", V.visible_keypoints(F.slice("embedding", 1, 63)).alias("visible"))


@query("select vec_id, cast(len(list_filter(range(64), lambda k: k % 2 = 0 and embedding[k + 1] >= 0)) as int) as n, cast(sum(c) as double) as confidence from (select vec_id, embedding, cast(unnest(list_transform(range(64), lambda k: case when k % 2 = 0 and embedding[k + 1] >= 0 and k < 40 then k else 0 end)) as int) as c from embeddings) group by vec_id, embedding")
def person_candidates(spark, d):
    """PF14, UD4: class 0 becomes label 1; missing confidences are 0."""
    e, places = F.col("embedding").cast("array<double>"), F.sequence(F.lit(0), F.lit(63))
    kinds = F.transform(places, lambda k: F.when((k % 2 == 0) & (F.get(e, k) >= 0), 0).otherwise(3))
    points = F.transform(places, lambda k: F.array(F.array(k.cast("double"), k.cast("double")), F.array(F.lit(1.0), F.lit(1.0))))
    sure = F.transform(places, lambda k: F.when(k < 40, F.array(k.cast("double"))))
    boxes = F.transform(places, lambda k: F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)))
    found = V.candidates(boxes, e, kinds, points, sure)
    total = F.aggregate(found, F.lit(0.0), lambda s, x: s + F.get(F.get(x["keypoints"], F.lit(0)), F.lit(2)) + F.get(F.get(x["keypoints"], F.lit(1)), F.lit(2)))
    return table(spark, d, "embeddings").select("vec_id", F.size(found).alias("n"), total.alias("confidence"))


@query("""
with a as (select o_orderkey as image_id, 'o' || o_orderkey || '.jpg' as file_name, l_linenumber as id, l_partkey as p, '0 ' || printf('%.6f %.6f %.6f %.6f', least(1.0, ((l_partkey % 90) + 5.0) / 128), 0.15, 10.0 / 128, 0.1) as head
           from orders join lineitem on l_orderkey = o_orderkey),
k as (select *, list_aggregate(list_transform(range(17), lambda j: printf('%.6f %.6f ', ((p + j) % 100) / 128, 0.25) || cast((p + j) % 3 as varchar)), 'string_agg', ' ') as points from a)
select image_id, file_name, string_agg(head || ' ' || points, chr(10) order by id, head || ' ' || points) || chr(10) as label from k group by 1, 2""")
def pose_labels(spark, d):
    """SF12, SK7, AG20: lines stand for persons; most coordinates are ties of the sixth place."""
    p = F.col("l_partkey")
    flat = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.array(((p + j) % 100).cast("double"), F.lit(50.0), ((p + j) % 3).cast("double"))))
    box = F.array((p % 90).cast("double"), F.lit(20.0), F.lit(10.0), F.lit(20.0))
    images = table(spark, d, "orders").select(F.col("o_orderkey").alias("image_id"), F.concat(F.lit("o"), "o_orderkey", F.lit(".jpg")).alias("file_name"), F.lit(128).alias("width"), F.lit(200).alias("height"))
    people = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("id"), box.alias("bbox"), flat.alias("keypoints"))
    return L.pose_labels(images, people)


PREDICTED = """
p as (select vec_id, case when vec_id % 6 = 0 then 'error' when vec_id % 6 = 1 then 'no_boxes' when vec_id % 6 = 2 then 'no_keypoints' end as skipped,
  list_aggregate(list_transform(range(17), lambda j: printf('%.6f %.6f ', ((vec_id + j) % 10) / 10, 0.5) || case when (vec_id + j) % 3 = 2 then '2' when (vec_id + j) % 3 = 1 then '1' else '0' end), 'string_agg', ' ') as points from embeddings)"""


def predicted(spark, d):
    k, places = F.col("vec_id"), F.sequence(F.lit(0), F.lit(16))
    xy = F.transform(places, lambda j: F.array(((k + j) % 10) / 10, F.lit(0.5)))
    sure = F.transform(places, lambda j: F.when((k + j) % 3 == 2, 0.5).when((k + j) % 3 == 1, 0.25))
    boxes = F.when(k % 6 == 1, F.array().cast("array<array<double>>")).otherwise(F.array(F.array(*map(F.lit, (0.5, 0.5, 0.25, 0.125)))))
    rows = table(spark, d, "embeddings").select(k.alias("sample_id"), F.lit("p").alias("image_path"), boxes.alias("boxes"), F.when(k % 6 != 2, F.array(xy)).alias("points"), F.array(sure).alias("confidences"), F.when(k % 6 == 0, "broken").alias("error"))
    return L.predicted_labels(rows, 0.5)


@query(f"with {PREDICTED} select vec_id, skipped, cast(case when skipped is null then 1 else 0 end as int) as n_persons, case when skipped is null then '0 0.500000 0.500000 0.250000 0.125000 ' || points || chr(10) end as label from p")
def predicted_labels(spark, d):
    """SF13, UD6."""
    return predicted(spark, d).select(F.col("sample_id").alias("vec_id"), "skipped", "n_persons", "label")


@query(f"with {PREDICTED} select coalesce(skipped, 'written') as outcome, count(*) as n from p group by 1")
def skipped_rows(spark, d):
    """PF25, SF24."""
    return L.skip_counts(predicted(spark, d))


@query("""
with t as (select c_custkey, o_orderkey from customer join orders on o_custkey = c_custkey where c_custkey % 2 = 0 and o_orderkey % 3 < 2)
select c_custkey || '_c' as sample_id, 'd/' || c_custkey || '_c.png' as image_path, string_agg(cast(o_orderkey % 3 as varchar) || printf(' 0.000000 0.000000 1.000000 0.500000 %.6f 1.000000', (o_orderkey % 100) / 100), chr(10) order by o_orderkey) || chr(10) as label from t group by c_custkey""")
def segment_labels(spark, d):
    """SF14, SF15, JN8: orders stand for polygons; a third of them has an unknown class, and every one a useless item beside it."""
    k, number = F.col("o_orderkey"), lambda *x: F.array(*(F.lit(float(v)) for v in x))
    points = F.array(number(0, -5), number(200, 50), number(7), F.array((k % 100).cast("double"), F.lit(100.0)))
    name = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("z")), (k % 3 + 1).cast("int"))
    item = lambda kind, p: F.struct(F.lit(kind).alias("type"), F.struct(F.array(name, F.lit("b")).alias("polygonlabels"), p.alias("points")).alias("value"))
    result = F.array(item("polygonlabels", points), item("rectanglelabels", points), item("polygonlabels", F.slice(points, 1, 2)))
    tasks = table(spark, d, "orders").select(F.concat(F.lit("s3://x/"), "o_custkey", F.lit("_c.png")).alias("image"), k.alias("pos"), result.alias("result"))
    files = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("d/"), "c_custkey", F.lit("_c.png")).alias("path"))
    return L.segment_labels(tasks, files, ["a", "b"])


@query("with s as (select vec_id, cast(embedding[1:32] as double[]) as a, cast(embedding[33:64] as double[]) as b from embeddings) select vec_id, list_inner_product(a, b) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b))) as cosine from s where list_inner_product(a, a) > 0 and list_inner_product(b, b) > 0")
def half_cosine(spark, d):
    """UD11."""
    e = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", V.cosine(F.slice(e, 1, 32), F.slice(e, 33, 32)).alias("cosine")).where("cosine is not null")


# more reports


@query("select round(coalesce(avg(s_acctbal) filter (where s_nationkey % 3 = 0), 0.0), 6) as real_mean, round(coalesce(avg(s_acctbal) filter (where s_nationkey % 3 = 1), 0.0), 6) as synthetic_mean from supplier")
def slice_means(spark, d):
    """AG13."""
    source = F.when(F.col("s_nationkey") % 3 == 0, "real").when(F.col("s_nationkey") % 3 == 1, "synthetic").otherwise("other")
    found = E.slice_means(table(spark, d, "supplier").select(source.alias("source"), F.col("s_acctbal").alias("score")))
    return found.select(*(F.round(c, 6).alias(c) for c in found.columns))  # sums of doubles depend on their order


@query("""
with v as (select p_partkey, (p_partkey % 101) / 100 as t, (p_size % 7) / 10 as r, (p_size % 5) / 10 as s from part),
m as (select *, cast(printf('%.4f', greatest(0.0, least(1.0, 0.4 + t * 0.5 + r * 0.08))) as double) as map50 from v)
select p_partkey, map50, cast(printf('%.4f', greatest(0.0, least(1.0, map50 - 0.13))) as double) as map50_95, cast(printf('%.4f', greatest(0.0, least(1.0, 0.35 + t * 0.4 + s * 0.12))) as double) as iou_mean, cast(printf('%.4f', greatest(0.01, least(1.0, 0.35 - t * 0.25))) as double) as calibration_error,
  case when map50 < 0.65 then 'tighten_filter' else 'relax_filter' end as action from m""")
def metric_formulas(spark, d):
    """AG14, AG24."""
    t, r, s = (F.col("p_partkey") % 101) / 100, (F.col("p_size") % 7) / 10, (F.col("p_size") % 5) / 10
    found = table(spark, d, "part").select("p_partkey", E.metric_formulas(t, r, s).alias("m")).select("p_partkey", "m.*")
    return found.withColumn("action", E.seg_policy(F.col("map50")))


@query("select p_partkey, greatest(0.0, least(0.99, cast(printf('%.4f', 0.5 + least(p_size / 100, 0.35) - 0.15 * abs((p_partkey % 11) / 10 - 0.5)) as double))) as metric from part")
def train_metric(spark, d):
    """AG16."""
    return table(spark, d, "part").select("p_partkey", E.train_metric(F.col("p_size"), (F.col("p_partkey") % 11) / 10).alias("metric"))


@query("select 0 as turn, count(*) filter (where c_nationkey < 9) as real, count(*) filter (where c_nationkey > 19) as synthetic, count(*) as total from customer union all select 1, count(*), 0, count(*) from supplier")
def dataset_sources(spark, d):
    """PF23: by the prefix of names, or by the path where no name has one."""
    name = F.concat(F.when(F.col("c_nationkey") < 9, "real_").when(F.col("c_nationkey") > 19, "synth_").otherwise("other_"), "c_name")
    first = E.path_sources(table(spark, d, "customer").select(name.alias("name")), "x/synth")
    return first.select(F.lit(0).alias("turn"), "*").unionByName(E.path_sources(table(spark, d, "supplier").select(F.col("s_name").alias("name")), "x/real_dataset").select(F.lit(1).alias("turn"), "*"))


@query(f"with a as ({SPLIT.format(seed=42, rows='documents')}), b as ({SPLIT.format(seed=43, rows='(select doc_id from a where r > greatest(1, floor(n * 0.15)))')}) select doc_id, 'test' as split from a where r <= greatest(1, floor(n * 0.15)) union all select doc_id, case when r <= greatest(1, floor(n * 0.2)) then 'val' else 'train' end from b")
def split_by_ratio(spark, d):
    """SO5, SO6: the test split by a ratio."""
    return R.split_with_holdout(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2, 42, test_ratio=0.15)


@query("select 'real_' || c_name as name, case when c_nationkey % 3 = 0 then 'train' else 'val' end as split from customer where c_nationkey % 3 < 2 union all select 'synth_' || s_name, 'train' from supplier")
def mixed_legacy(spark, d):
    """SO3 without a shared evaluation set: train and val of both."""
    split = F.when(F.col("c_nationkey") % 3 == 0, "train").when(F.col("c_nationkey") % 3 == 1, "val").otherwise("test")
    return R.mixed_dataset(table(spark, d, "customer").select(F.col("c_name").alias("name"), split.alias("split")), table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("train").alias("split")))


@query("select 'image' as kind, o_orderkey as id from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' group by 1 having count(*) = 1) union all select 'annotation', l_partkey from lineitem where l_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' group by 1 having count(*) = 1) union all select distinct 'licence', o_custkey % 25 from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' group by 1 having count(*) = 1)")
def single_person_tables(spark, d):
    """OR13: images, annotations and licences of the subset."""
    lines = table(spark, d, "lineitem")
    images = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 25).alias("license"))
    kept, annotations, licences = R.subset(R.single_only(lines, "l_orderkey", F.col("l_returnflag") == "R"), "l_orderkey", images, lines, spark.range(25))
    row = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id"))
    return row(kept, "image", "l_orderkey").unionByName(row(annotations, "annotation", "l_partkey")).unionByName(row(licences, "licence", "id"))


# streams


@query("select date_trunc('day', ts)::timestamp as day, event_type, count(*) as n from events group by 1, 2")
def stream_window_counts(spark, d):
    """Windowed counts of a finite stream, over all its events."""
    events = table(spark, d, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events.parquet*")
    return replay(window_counts(stream), ["day", "event_type"])


@query(f"with {MARGIN} select vec_id as id, margin, case when margin >= {THRESHOLD} then 'accept' else 'reject' end as decision from m")
def stream_decisions(spark, d):
    """PF4 on a stream: the same rows as margin_decision."""
    stored = table(spark, d, "embeddings")
    e = F.col("embedding").cast("array<double>")
    stream = spark.readStream.schema(stored.schema).parquet(f"{d}/embeddings.parquet*")
    return replay(decisions(stream.select(F.col("vec_id").alias("id"), F.slice(e, 1, 32).alias("positive"), F.slice(e, 33, 32).alias("negative")), THRESHOLD))


#: Of events, at most: a longer log is read in larger batches.
BATCHES = 8


def event_stream(spark, d, rows, by=None):
    """by: the log is put in the order of this time first."""
    events, folder = table(spark, d, "events"), stream_folder(spark)
    return EV.stream_of(spark, EV.in_order(events, by, folder) if by else f"{d}/events.parquet", events.schema, folder, rows, batches=BATCHES)


@query("select event_id, ts, user_id, event_type, value, props from events")
def streamed_events(spark, d):
    """SC14: every event once, through the source of job events, in batches."""
    return replay(event_stream(spark, d, 5000), paced=True)


LIVES = """
with recursive k as (select user_id as job, epoch_us(ts) as tm, event_id, case event_type when 'signup' then 'submit' when 'purchase' then 'finish' else 'progress' end as kind
  from events where event_type in ('signup', 'purchase', 'view', 'click') and user_id is not null and ts is not null),
w as (select max(tm) // 1000 * 1000 - 3600000000 as w from k),
o as (select job, tm, kind, row_number() over (partition by job order by tm, event_id) as n from k, w where tm <= w),
e as (select * from o union all select job, w, 'end', max(n) + 1 from o, w group by job, w),
s as (
  select job, cast(0 as bigint) as n, 'idle' as status, 0 as attempt, cast(0 as bigint) as since, cast([] as struct(attempt int, status varchar, tm bigint)[]) as told from (select distinct job from o)
  union all
  select job, n, case when kind = 'submit' and b not in ('submitted', 'running') then 'submitted' when kind = 'progress' and b = 'submitted' then 'running' when kind = 'finish' and b in ('submitted', 'running') then 'done' else b end,
    case when kind = 'submit' and b not in ('submitted', 'running') then 0 else c end,
    case when kind = 'submit' and b not in ('submitted', 'running') then tm else since + 21600000000 * x end,
    list_concat(flatten([[{'attempt': attempt + i - 1, 'status': 'timed_out', 'tm': since + 21600000000 * i}, {'attempt': case when attempt + i > 1 then attempt + i - 1 else attempt + i end, 'status': case when attempt + i > 1 then 'failed' else 'submitted' end, 'tm': since + 21600000000 * i}] for i in range(1, x + 1)]),
      case when kind = 'submit' and b not in ('submitted', 'running') then [{'attempt': 0, 'status': 'submitted', 'tm': tm}] when kind = 'progress' and b = 'submitted' then [{'attempt': c, 'status': 'running', 'tm': tm}]
           when kind = 'finish' and b in ('submitted', 'running') then [{'attempt': c, 'status': 'done', 'tm': tm}] else [] end)
  from (select *, case when x = 0 then status when x > 1 - attempt then 'failed' else 'submitted' end as b, attempt + least(x, 1 - attempt) as c
    from (select s.job, e.n, e.kind, e.tm, s.status, s.attempt, s.since, cast(case when s.status in ('submitted', 'running') then least((e.tm - s.since - 1) // 21600000000, 2 - s.attempt) else 0 end as int) as x from s join e on e.job = s.job and e.n = s.n + 1)))
select job, t.attempt as attempt, t.status as status, make_timestamp(t.tm) as at from (select job, unnest(told) as t from s)"""


@query(LIVES)
def job_transitions(spark, d):
    """UD9, SC13: signups submit, views and clicks run, purchases end; six hours for an attempt, two attempts, an hour for late events."""
    t = F.col("event_type")
    kind = F.when(t == "signup", J.SUBMIT).when(t.isin("view", "click"), J.PROGRESS).when(t == "purchase", J.FINISH)
    lives = J.job_lives(event_stream(spark, d, 5000, "ts"), kind, 6 * 3600, 1, "1 hour")
    return replay(lives, paced=True).withColumn("at", F.col("at").cast("timestamp_ntz"))


# one-pass sinks


@query(f"""with {MARGIN}, r as (select vec_id, case when margin >= {THRESHOLD} then 'accept' else 'reject' end as decision, margin from m)
select decision as part, vec_id, decision, margin from r union all select 'scores', vec_id, decision, margin from r""")
def decision_files(spark, d):
    """SK3: a manifest for each decision and the score table, written in one pass, and read again by the batch's record."""
    path = stream_folder(spark)
    TX.write_decisions(margin_decision(spark, d), path, "first")
    TX.write_decisions(margin_decision(spark, d), path, "first")  # the same batch is there
    parts = [TX.read_part(spark, path, p, "vec_id long, margin double, decision string").withColumn("part", F.lit(p)) for p in ("accept", "reject", "scores")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("part", "vec_id", "decision", "margin")


@query(f"with {DET}, w as (select vec_id, {ROUTED} as decision from r) select decision as part, vec_id, decision from w union all select 'scores', vec_id, decision from w")
def routed_files(spark, d):
    """SK4: three manifests and the score table in one pass, read again by the batch's record."""
    path = stream_folder(spark)
    routed = gated(spark, d).select("vec_id", G.route(F.col("reject_reasons"), ROUTES).alias("decision"))
    TX.write_decisions(routed, path, "b", ("accept", "reject", "uncertain"))
    found = None
    for p in ("accept", "reject", "uncertain", TX.SCORES):
        part = TX.read_part(spark, path, p, "vec_id long, decision string").select(F.lit(p).alias("part"), "vec_id", "decision")
        found = part if found is None else found.unionByName(part)
    return found


@query("select 'tasks' as part, count(*) as lines, true as files from documents where source <> 'src1'")
def task_lists(spark, d):
    """SK13: tasks in lists of at most 500, as they are kept to be sent once."""
    path = stream_folder(spark)
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.when(F.col("source") != "src1", F.col("source")).alias("image_url"))
    line = F.to_json(F.struct("data", "meta"))
    TX.write_lines(M.import_tasks(rows).select(F.lit("tasks").alias("part"), line.alias("line")), path, "b1", ["tasks"], 500)
    found = TX.records(spark, path)
    return found.groupBy("part").agg(F.sum("rows").alias("lines"), (F.count("file") * 500 >= F.sum("rows")).alias("files"))


# exact decimals


@query("select o_orderkey, printf('%.6f', x) as six, printf('%.2f', -x) as two, cast(printf('%.4f', x / 3) as double) as four from (select o_orderkey, (o_custkey % 4096) / 128 - 8 as x from orders)")
def exact_places(spark, d):
    """SF12, SF21, AG12: text and rounding of ties and of what only seems to be one."""
    x = (F.col("o_custkey") % 4096) / 128 - 8
    return table(spark, d, "orders").select("o_orderkey", D.fixed_text(x, 6).alias("six"), D.fixed_text(-x, 2).alias("two"), D.rounded(x / 3, 4).alias("four"))


# jobs in flight


class Slow:
    """A client over the table at hand: job k is ready so many ticks after it was submitted, and gives k % 3 outputs."""

    def __init__(self):
        self.now, self.jobs = 0, {}

    def clock(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds

    def submit(self, request, key):
        number, attempt = int(request), int(key.rsplit("-", 1)[1])
        self.jobs[key] = (self.now + (number + 3 * attempt) % 7, [f"{number}/{j}" for j in range(number % 3)])
        return key

    def fetch(self, name):
        ready, outputs = self.jobs[name]
        return outputs if self.now >= ready and self.jobs.pop(name) else None


@query("""
with j as (select o_orderkey as job, case when o_orderkey % 7 > 4 then 1 else 0 end as late from orders)
select job, job + 5 as seed, cast(late as int) as attempt, 'done' as status, cast(k as int) as place, job || '/' || k as output from j, range(2) t(k) where k < job % 3
union all select job, job + 5, 0, 'retried', null, null from j where late = 1""")
def jobs_in_flight(spark, d):
    """UD8, UD9, SC13: orders stand for jobs: eight in flight in each of four tasks, done after 0 to 4 ticks or tried again."""
    plan = table(spark, d, "orders").select(F.col("o_orderkey").alias("job"), (F.col("o_orderkey") + 5).alias("seed"), F.col("o_orderkey").cast("string").alias("request"))
    found = W.run_jobs(plan, Slow, 1 << 60, partitions=4, max_inflight=8, timeout=4, every=1, policy="retry", retries=2, run="r")
    return found.select("job", "seed", "attempt", "status", "place", "output")


# rows of any fields


def variant_rows(spark, d):
    k = F.col("c_custkey")
    text = F.when(k % 5 == 0, '{"image_path": null, "imagepath": "second", "sample_id": null}').when(k % 5 == 1, '{"imagepath": "second", "sample_id": "None"}').when(k % 5 == 2, '{"image_path": "None", "sample_id": true}').when(k % 5 == 3, '{"image_path": " x ", "sample_id": 7, "more": [1, 2]}').otherwise('{"path": "third", "sample_id": ""}')
    return table(spark, d, "customer").select(k, F.parse_json(text).alias("v"))


@query("""
select c_custkey, c_custkey % 5 in (0, 2, 3) as has_path, c_custkey % 5 = 0 as null_path, case c_custkey % 5 when 0 then 'None' when 1 then null when 2 then 'None' when 3 then ' x ' end as printed,
  case c_custkey % 5 when 0 then 'second' when 1 then 'second' when 2 then 'None' when 3 then 'x' else 'third' end as path, case c_custkey % 5 when 0 then 'None' when 1 then 'second' when 2 then 'None' when 3 then 'x' else 'third' end as path_of_none,
  case c_custkey % 5 when 1 then 'None' when 2 then 'True' when 3 then '7' else 'row_' || printf('%07d', c_custkey) end as sample_id, c_custkey % 5 = 3 as more
from customer""")
def explicit_nulls(spark, d):
    """PF2, PF3, SC1: a null, a field that is not there, and the text None are three things."""
    rows, v = variant_rows(spark, d), F.col("v")
    path = VT.field(v, "image_path")
    told = rows.select("c_custkey", VT.has(v, "image_path").alias("has_path"), F.coalesce(F.is_variant_null(path), F.lit(False)).alias("null_path"), VT.printed(path).alias("printed"))
    strict, loose = (VT.filter_rows(rows.withColumn("v", VT.with_nested(v, {("row", "key", "k"): F.col("c_custkey")})), "c_custkey", none).withColumn("c_custkey", F.variant_get("raw", "$.row.key.k", "long")) for none in (None, "None"))
    both = strict.join(loose.select("c_custkey", F.col("image_path").alias("path_of_none")), "c_custkey")
    return told.join(both.select("c_custkey", F.col("image_path").alias("path"), "path_of_none", "sample_id", F.variant_get("raw", "$.more", "variant").isNotNull().alias("more")), "c_custkey")


@query("""
select c_custkey, lpad(left(c_mktsegment, 3), 8, '.') || '|' || case when length(c_name) >= 24 then c_name else repeat(' ', (24 - length(c_name)) // 2) || c_name || repeat(' ', 24 - length(c_name) - (24 - length(c_name)) // 2) end
  || '|' || chr(39) || c_mktsegment || chr(39) || '|{unknown}|  {gone}|{' || c_custkey || '}|' || c_mktsegment as text from customer""")
def formatted_prompts(spark, d):
    """SF6, SF7: widths, alignment, fills, precision, conversions, braces, unknown names, and a field that a value brings in."""
    fields = {"segment": F.col("c_mktsegment"), "name": F.col("c_name"), "key": F.col("c_custkey"), "inner": F.lit("{segment}")}
    made = S.render("{segment:.>8.3}|{name:^24}|{segment!r}|{unknown}|{gone:>8}|{{$key}}|$inner", fields)
    return table(spark, d, "customer").select("c_custkey", made.alias("text"))


@query()
def seeded_choices(spark, d):
    """SF8, SF22: words and augmentations as the standard generator draws them (tested against it)."""
    from .functions import draws

    k = F.col("o_orderkey")
    words = draws.dynamic_choices({"pose": ["sit", "stand", "run"], "place": [f"p{j}" for j in range(11)], "style": "plain"}, "salt", k, k + 5, F.col("o_orderstatus"), F.lit(None).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", *(c.alias(n) for n, c in words.items()), draws.augmentations(k + 5).alias("a")).select("o_orderkey", *words, "a.*")
