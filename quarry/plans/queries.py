"""Queries over the driver's tables, each with its SQL twin.

Images, objects and judge texts are derived from orders, line items and customers; VIEWS has the expressions, which
are the same in both engines. All run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import describe, parse, text
from quarry.operators import detect, geometry, partition, resume, sample, scores, tasks
from quarry.streaming.incremental import windowed_counts

SEED, PARTS = 7, 8
#: view: table, expressions.
VIEWS = {
    "img": ("orders", [
        "o_orderkey AS image_id", "CAST(512 + o_orderkey % 1500 AS DOUBLE) AS height", "CAST(512 + o_custkey % 1500 AS DOUBLE) AS width",
        "CAST(4.0 AS DOUBLE) + (o_custkey % 300) / CAST(100 AS DOUBLE) AS aes", "o_orderpriority AS edit_type",
    ]),
    "obj": ("lineitem", [
        "l_orderkey AS image_id", "l_linenumber AS idx", "l_partkey AS pk", "l_suppkey AS sk", "l_quantity AS qty",
        "concat(l_returnflag, l_linestatus) AS class_name", "CAST(l_partkey % 900 AS DOUBLE) AS x1", "CAST((l_suppkey * 37) % 900 AS DOUBLE) AS y1",
        "l_partkey % 900 + l_quantity * 18 AS x2", "(l_suppkey * 37) % 900 + l_quantity * 12 AS y2",
        "l_discount * 10 AS score", "l_tax * CAST(12.5 AS DOUBLE) AS clip_score",
    ]),
    "judge": ("customer", [
        "CAST(c_custkey AS STRING) AS key", "c_mktsegment AS edit_type",
        "concat('Brief reasoning: the edit follows', chr(10), 'Prompt Compliance: ', CAST(c_custkey % 5 + 1 AS STRING), chr(10), 'Visual Seamlessness: ', CAST(c_custkey % 4 + 1 AS STRING),"
        " CASE WHEN c_custkey % 7 = 0 THEN ' (Fair)' ELSE '' END, chr(10), 'Physical Consistency: ', CAST(c_custkey % 3 + 1 AS STRING)) AS text",
    ]),
    "resp": ("nation", [
        "n_nationkey AS key", "concat('prompt: move ', n_name, ', result1: a ', n_name, ', result2: b', CAST(n_regionkey AS STRING), '.') AS hybrid",
        "concat('{\"background\": [\"sky\", \"', n_name, '\"], \"object\": [\"r', CAST(n_regionkey AS STRING), '\"], \"summary\": [\"a view of ', n_name, '\"],}') AS recap",
        "concat('Brief reasoning: x', chr(10), 'Score 1: ', CAST(n_nationkey % 6 AS STRING), chr(10), 'Score 2: ', CAST(n_regionkey + 1 AS STRING), chr(10), 'Objects match: ', CASE WHEN n_nationkey % 3 = 0 THEN 'No' ELSE 'Yes' END) AS pair",
    ]),
}
TIES = ("idx", "pk", "sk", "qty")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = VIEWS[name]
    return read(spark, sf_dir, source).selectExpr(*expressions)


def _with(*names: str) -> str:
    return ", ".join(f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {_with('judge')}, lines AS (SELECT key, edit_type, unnest(string_split(text, chr(10))) AS line FROM judge),
parts AS (SELECT key, edit_type, string_split(trim(line), ': ') AS p FROM lines),
per_key AS (SELECT key, edit_type, round_even(avg(CAST(p[2] AS DOUBLE)), 2) AS score FROM parts WHERE len(p) = 2 AND regexp_full_match(p[2], '[0-9]+') GROUP BY ALL)
SELECT edit_type, round_even(avg(score), 2) AS score, count(*) AS n FROM per_key GROUP BY edit_type""")
def q_type_scores(spark, sf_dir):
    judged = view(spark, sf_dir, "judge")
    return scores.type_scores(scores.item_scores(judged), judged)


@query(f"""WITH {_with('judge')}, lines AS (SELECT key, unnest(string_split(text, chr(10))) AS line FROM judge),
parts AS (SELECT key, string_split(trim(line), ': ') AS p FROM lines),
per_key AS (SELECT key, round_even(avg(CAST(p[2] AS DOUBLE)), 2) AS score FROM parts WHERE len(p) = 2 AND regexp_full_match(p[2], '[0-9]+') GROUP BY ALL)
SELECT round_even(avg(score), 2) AS score, count(*) AS n FROM per_key""")
def q_overall_score(spark, sf_dir):
    return scores.overall_score(scores.item_scores(view(spark, sf_dir, "judge")))


@query(f"WITH {_with('img')} SELECT image_id, height, width, aes FROM img WHERE aes > 4.75 AND height > 512 AND width > 512")
def q_quality_filter(spark, sf_dir):
    return geometry.good_images(view(spark, sf_dir, "img")).select("image_id", "height", "width", "aes")


def _targets(spark, sf_dir, limits):
    joined = view(spark, sf_dir, "obj").join(view(spark, sf_dir, "img").select("image_id", "height", "width"), "image_id")
    area = geometry.box_area(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    return joined.where(geometry.is_target(area, F.col("height") * F.col("width"), F.col("score"), F.col("clip_score"), limits))


def _target_sql(low, high, area, score, clip):
    return f"""SELECT o.*, height, width FROM obj o JOIN img USING (image_id)
WHERE (x2 - x1) * (y2 - y1) > {low}::DOUBLE * (height * width) AND (x2 - x1) * (y2 - y1) <= {high}::DOUBLE * (height * width)
AND (clip_score >= {clip}::DOUBLE OR ((x2 - x1) * (y2 - y1) >= {area}::DOUBLE * (height * width) AND score >= {score}::DOUBLE))"""


OBJECT_SQL, BACKGROUND_SQL = _target_sql(0.01, 0.6, 0.08, 0.8, 0.8), _target_sql(0.4, 0.7, 0.4, 0.75, 0.7)


@query(f"WITH {_with('img', 'obj')}, t AS ({OBJECT_SQL}) SELECT image_id, idx, pk, sk, qty, class_name FROM t")
def q_object_candidates(spark, sf_dir):
    return _targets(spark, sf_dir, geometry.OBJECT).select("image_id", *TIES, "class_name")


@query(f"WITH {_with('img', 'obj')}, t AS ({BACKGROUND_SQL}) SELECT image_id, idx, pk, sk, qty, class_name FROM t")
def q_background_candidates(spark, sf_dir):
    return _targets(spark, sf_dir, geometry.BACKGROUND).select("image_id", *TIES, "class_name")


@query(f"WITH {_with('obj')} SELECT image_id, class_name, count(*) AS n FROM obj GROUP BY ALL")
def q_object_counts(spark, sf_dir):
    return detect.counts(view(spark, sf_dir, "obj"))


@query(f"""WITH {_with('obj')}, c AS (SELECT image_id, class_name, count(*) AS n FROM obj GROUP BY ALL)
SELECT image_id, string_agg(class_name || '=' || n, ',' ORDER BY class_name) AS counts FROM c GROUP BY image_id""")
def q_object_count_map(spark, sf_dir):
    found = detect.count_map(view(spark, sf_dir, "obj"))
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select("image_id", F.array_join(entries, ",").alias("counts"))


def _far_sql(a, b):
    gap = f"sqrt(pow(greatest(0, {b}.x1 - {a}.x2, {a}.x1 - {b}.x2), 2) + pow(greatest(0, {b}.y1 - {a}.y2, {a}.y1 - {b}.y2), 2)) > 100"
    return f"({a}.x2 < {b}.x1 OR {b}.x2 < {a}.x1 OR {a}.y2 < {b}.y1 OR {b}.y2 < {a}.y1) AND {gap}"


@query(f"""WITH {_with('obj')}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, idx, pk, sk, qty) AS rn FROM obj),
t AS (SELECT * FROM r WHERE rn <= 100) -- O-62: the detector's own top-k
SELECT a.image_id, a.rn::BIGINT AS first_rank, b.rn::BIGINT AS second_rank, a.class_name AS first_class, b.class_name AS second_class
FROM t a JOIN t b ON a.image_id = b.image_id AND a.rn < b.rn AND a.class_name <> b.class_name AND {_far_sql('a', 'b')}""")
def q_far_pairs(spark, sf_dir):
    """Pairs among what the detector's own cut (O-62) leaves of an image: detect.TOP_K boxes, so 4,950 pairs at most."""
    best = detect.top_k(view(spark, sf_dir, "obj"), ties=TIES)
    box = F.struct("rank", "class_name", "x1", "y1", "x2", "y2")
    listed = best.groupBy("image_id").agg(F.array_sort(F.collect_list(box)).alias("boxes"))

    def partners(a):
        far = lambda b: (a["rank"] < b["rank"]) & (a["class_name"] != b["class_name"]) & geometry.far_apart(a, b)
        return F.transform(F.filter("boxes", far), lambda b: F.struct(
            a["rank"].cast("long").alias("first_rank"), b["rank"].cast("long").alias("second_rank"),
            a["class_name"].alias("first_class"), b["class_name"].alias("second_class")))

    pairs = F.explode(F.flatten(F.transform("boxes", partners))).alias("pair")
    return listed.select("image_id", pairs).select("image_id", "pair.*")


@query(f"""WITH {_with('obj')}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws(':', image_id, idx, '{SEED}')), idx, pk, sk, qty) AS rn FROM obj)
SELECT a.image_id, a.class_name AS first_class, b.class_name AS second_class, (a.class_name <> b.class_name AND {_far_sql('a', 'b')}) AS usable
FROM r a JOIN r b ON a.image_id = b.image_id AND a.rn = 1 AND b.rn = 2""")
def q_sampled_pair(spark, sf_dir):
    """Two boxes drawn for each image, then tested."""
    drawn = sample.pick(view(spark, sf_dir, "obj"), "image_id", 2, SEED, TIES)
    box = F.struct("class_name", "x1", "y1", "x2", "y2")
    both = drawn.groupBy("image_id").agg(F.max(F.when(F.col("pick") == 1, box)).alias("a"), F.max(F.when(F.col("pick") == 2, box)).alias("b"))
    a, b = F.col("a"), F.col("b")
    usable = (a["class_name"] != b["class_name"]) & geometry.far_apart(a, b)
    return both.where(b.isNotNull()).select("image_id", a["class_name"].alias("first_class"), b["class_name"].alias("second_class"), usable.alias("usable"))


@query(f"""WITH RECURSIVE {_with('obj')}, r AS (SELECT image_id, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, idx, pk, sk, qty) AS rn,
{{'idx': idx, 'pk': pk, 'sk': sk, 'qty': qty, 'score': score, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} AS k FROM obj),
s AS (SELECT image_id, rn, [k] AS kept FROM r WHERE rn = 1 UNION ALL
SELECT r.image_id, r.rn, CASE WHEN len(list_filter(kept, lambda o:
  greatest(0, least(k.x2, o.x2) - greatest(k.x1, o.x1)) * greatest(0, least(k.y2, o.y2) - greatest(k.y1, o.y1))
  / nullif((k.x2 - k.x1) * (k.y2 - k.y1) + (o.x2 - o.x1) * (o.y2 - o.y1) - greatest(0, least(k.x2, o.x2) - greatest(k.x1, o.x1)) * greatest(0, least(k.y2, o.y2) - greatest(k.y1, o.y1)), 0) > 0.5)) = 0
  THEN list_append(kept, k) ELSE kept END FROM s JOIN r ON r.image_id = s.image_id AND r.rn = s.rn + 1),
e AS (SELECT image_id, unnest(arg_max(kept, rn)) AS k FROM s GROUP BY image_id)
SELECT image_id, k.idx AS idx, k.pk AS pk, k.sk AS sk, k.qty AS qty, k.score AS score FROM e""")
def q_nms(spark, sf_dir):
    boxes = view(spark, sf_dir, "obj").select("image_id", *TIES, "score", "x1", "y1", "x2", "y2")
    return detect.suppress(boxes, ties=TIES).select("image_id", *TIES, "score")


@query(f"""WITH {_with('obj')}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, idx, pk, sk, qty) AS rn FROM obj WHERE score > 0.005)
SELECT image_id, idx, pk, sk, qty, score, rn::BIGINT AS rank FROM r WHERE rn <= 2""")
def q_topk_detections(spark, sf_dir):
    best = detect.top_k(detect.confident(view(spark, sf_dir, "obj")), k=2, ties=TIES)
    return best.select("image_id", *TIES, "score", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {_with('obj')}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws(':', image_id, idx, '{SEED}')), idx, pk, sk, qty) AS rn FROM obj)
SELECT image_id, idx, pk, sk, qty, class_name FROM r WHERE rn = 1""")
def q_pick_object(spark, sf_dir):
    return sample.pick_one(view(spark, sf_dir, "obj").select("image_id", *TIES, "class_name"), "image_id", SEED, TIES)


@query(f"""WITH {_with('img')}, d AS (SELECT image_id, o, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws(':', image_id, o, i, '{SEED}'))) AS rn
FROM img, (VALUES (0, 'add'), (1, 'remove'), (2, 'replace'), (3, 'adjust')) v(i, o))
SELECT image_id, string_agg(o, ',' ORDER BY rn) AS operations FROM d WHERE rn <= 2 GROUP BY image_id""")
def q_pick_operations(spark, sf_dir):
    drawn = sample.two_operations(F.col("image_id").cast("string"), SEED)
    return view(spark, sf_dir, "img").select("image_id", F.array_join(drawn, ",").alias("operations"))


@query(f"SELECT doc_id, (ntile({PARTS}) OVER (ORDER BY doc_id) - 1)::BIGINT AS part FROM documents")
def q_split_contiguous(spark, sf_dir):
    return partition.contiguous(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", PARTS)


@query(f"SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % {PARTS})::BIGINT AS part FROM documents")
def q_split_stride(spark, sf_dir):
    return partition.strided(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", PARTS)


@query(f"""WITH {_with('img', 'obj')} SELECT image_id, idx, pk, sk, qty,
concat('summary: ', edit_type, ', object: ''', class_name, ''', resolution: ', height::BIGINT, 'x', width::BIGINT, ', object bbox: [',
round_even(x1, 0)::BIGINT, ',', round_even(y1, 0)::BIGINT, ',', round_even(x2, 0)::BIGINT, ',', round_even(y2, 0)::BIGINT, '].') AS description
FROM obj JOIN img USING (image_id)""")
def q_bbox_description(spark, sf_dir):
    joined = view(spark, sf_dir, "obj").join(view(spark, sf_dir, "img"), "image_id")
    told = describe.target(F.col("edit_type"), F.col("class_name"), describe.size_text(F.col("height"), F.col("width")), describe.box_text(F.array("x1", "y1", "x2", "y2")))
    return joined.select("image_id", *TIES, told.alias("description"))


@query(f"""WITH {_with('resp')}, p AS (SELECT key, regexp_extract(hybrid, '^prompt:\\s*(.*?),?\\s*result1:\\s*(.*?),?\\s*result2:\\s*(.*?)\\s*$', ['prompt', 'result1', 'result2']) AS r FROM resp)
SELECT key, rtrim(trim(r.prompt), '.') AS prompt, rtrim(trim(r.result1), '.') AS result1, rtrim(trim(r.result2), '.') AS result2 FROM p""")
def q_parse_hybrid(spark, sf_dir):
    return view(spark, sf_dir, "resp").select("key", parse.response(F.col("hybrid"), "hybrid").alias("r")).select("key", "r.*")


@query(f"""WITH {_with('resp')}, s AS (SELECT key, replace(recap, '"', '''') AS t FROM resp)
SELECT key, list_aggregate(list_transform(string_split(regexp_extract(t, '''background''\\s*:\\s*\\[(.*?)\\]', 1), ''', '''), lambda x: trim(x, ''' ')), 'string_agg', '|') AS background,
list_aggregate(list_transform(string_split(regexp_extract(t, '''object''\\s*:\\s*\\[(.*?)\\]', 1), ''', '''), lambda x: trim(x, ''' ')), 'string_agg', '|') AS object,
trim(regexp_extract(t, '''summary''\\s*:\\s*\\[(.*?)\\]', 1), ''' ') AS summary, true AS ok FROM s""")
def q_recap_parse(spark, sf_dir):
    """The responses end with a comma too many, so the fallback reads them."""
    found = view(spark, sf_dir, "resp").select("key", parse.recap(F.col("recap")).alias("r"))
    return found.select("key", F.array_join("r.background", "|").alias("background"), F.array_join("r.object", "|").alias("object"), "r.summary", "r.ok")


@query(f"""WITH {_with('resp')}, p AS (SELECT key, TRY_CAST(regexp_extract(pair, 'Score 1: ([0-9]+)', 1) AS INTEGER) AS score1,
TRY_CAST(regexp_extract(pair, 'Score 2: ([0-9]+)', 1) AS INTEGER) AS score2, contains(pair, 'Objects match: Yes') AS objects_match FROM resp)
SELECT *, score1 >= 4 AND score2 >= 4 AND objects_match AS accepted FROM p""")
def q_pair_scores(spark, sf_dir):
    found = view(spark, sf_dir, "resp").select("key", parse.pair_scores(F.col("pair")).alias("p"))
    return found.select("key", "p.*", parse.accepted(F.col("p")).alias("accepted"))


@query("SELECT page_id, replace(replace(url, '/', ''), '.com', '') AS key, replace(split_part(url, '.', 1), '/', '_') AS task FROM pages")
def q_record_key(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", text.record_key(url, ".com").alias("key"), text.task_id(url).alias("task"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_resume_anti(spark, sf_dir):
    return resume.missing(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), read(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, n_chars, NULL::INTEGER AS quality FROM documents UNION ALL SELECT doc_id, NULL::BIGINT, quality FROM labels")
def q_merge_bag(spark, sf_dir):
    return resume.merged(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality")))


@query(f"""WITH {_with('obj')} SELECT image_id, idx, pk, sk, qty, CASE WHEN class_name IN ('AF', 'NO') THEN 'object' WHEN class_name IN ('RF', 'NO') THEN 'background' END AS kind FROM obj""")
def q_class_assign(spark, sf_dir):
    objects, backgrounds = (F.array(*[F.lit(x) for x in names]) for names in (("AF", "NO"), ("RF", "NO")))
    return view(spark, sf_dir, "obj").select("image_id", *TIES, detect.class_kind(F.col("class_name"), objects, backgrounds).alias("kind"))


@query("""SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS turn1, max(CASE WHEN turn = 1 THEN text END) AS turn2, max(CASE WHEN turn = 2 THEN text END) AS turn3
FROM conversations GROUP BY conv_id""")
def q_turn_pivot(spark, sf_dir):
    columns = [F.max(F.when(F.col("turn") == k, F.col("text"))).alias(f"turn{k + 1}") for k in range(3)]
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(*columns)


@query("""WITH r AS (SELECT conv_id, count(*) % 3 AS n FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, n, ['add', 'remove', 'replace', 'adjust'][conv_id % 4 + 1] AS op0, ['add', 'remove', 'replace', 'adjust'][conv_id // 4 % 4 + 1] AS op1 FROM r)
SELECT conv_id, CASE WHEN n = 0 THEN 'compose_' || op0 WHEN n = 1 OR op1 IN ('add', 'remove') THEN 'compose_' || op1 END AS driver,
CASE WHEN n = 0 THEN 0 WHEN n = 1 OR op1 IN ('add', 'remove') THEN 1 END::BIGINT AS turn,
CASE WHEN n = 0 THEN 'original' WHEN n = 1 OR op1 IN ('add', 'remove') THEN 'result_0' END AS source FROM t""")
def q_next_turn(spark, sf_dir):
    """Tasks of two operations, of which none, the first or both have a result."""
    names = F.array(*[F.lit(o) for o in sample.OPERATIONS])
    made = read(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.count("*") % 3).alias("n"))
    todo = made.select("conv_id", "n", F.array(F.get(names, F.col("conv_id") % 4), F.get(names, F.floor(F.col("conv_id") / 4) % 4)).alias("operations"))
    done = F.when(F.col("n") > 0, F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    step = tasks.ready_turn(F.col("operations"), done, [f"compose_{o}" for o in sample.OPERATIONS])
    return todo.select("conv_id", step.alias("next")).select("conv_id", "next.driver", "next.turn", "next.source")


@query("""SELECT conv_id, string_agg(coalesce(role, '') || '>' || coalesce(text, ''), '|' ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS data FROM conversations GROUP BY conv_id""")
def q_dataset_rows(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations")
    turns = rows.select("conv_id", "turn", F.array("role").alias("input_images"), F.array("text").alias("output_images"), F.col("text").alias("prompt"))
    found = tasks.dataset_rows(turns, "conv_id")
    told = F.transform("data", lambda x: F.concat(F.coalesce(x["input_images"][0], F.lit("")), F.lit(">"), F.coalesce(x["prompt"], F.lit(""))))
    return found.select("conv_id", F.array_join(told, "|").alias("data"))


@query("SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY event_type")
def q_event_props_json(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def q_event_windows(spark, sf_dir):
    found = windowed_counts(read(spark, sf_dir, "events").select("ts", "event_type", "value"))
    return found.withColumn("total", F.round("total", 4))


@query(f"""WITH {_with('img')}, t AS (SELECT image_id, floor(height * 512 / least(height, width))::BIGINT AS tall, floor(width * 512 / least(height, width))::BIGINT AS wide FROM img)
SELECT image_id, tall - tall % 16 AS height, wide - wide % 16 AS width, tall % 16 // 2 AS "top", wide % 16 // 2 AS "left" FROM t""")
def q_resize_geometry(spark, sf_dir):
    return view(spark, sf_dir, "img").select("image_id", geometry.fitted(F.col("height"), F.col("width")).alias("g")).select("image_id", "g.*")


@query(f"""WITH {_with('judge')} SELECT j.key, template, CASE WHEN template IS NULL THEN concat('no rubric for ', coalesce(j.edit_type, 'null')) END AS error
FROM judge j LEFT JOIN (VALUES ('BUILDING', 'rate {{{{{{}}}}}}'), ('MACHINERY', 'judge {{{{{{}}}}}}')) r(edit_type, template) USING (edit_type)""")
def q_rubric_lookup(spark, sf_dir):
    rubrics = spark.createDataFrame([("BUILDING", "rate {{{}}}"), ("MACHINERY", "judge {{{}}}")], "edit_type string, template string")
    return scores.with_rubric(view(spark, sf_dir, "judge"), rubrics).select("key", "template", "error")
