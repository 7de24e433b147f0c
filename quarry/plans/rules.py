"""Queries over the text functions, parsers, descriptions, draws and edit tasks, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import describe, masks, parse, runs, text
from quarry.operators import batches, detect, geometry, pacing, resume, sample, scores, tasks
from quarry.operators.partition import new_folder
from quarry.sources import readers, versions, writers
from quarry.streaming.turns import follow_turns

from .queries import SEED, TIES, _far_sql, _with, query, read, view


def _lit(items):
    return F.array(*map(F.lit, items))


@query("SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ' '), lambda w: lower(w) NOT IN ('red', 'green', 'steel', 'small')), '|') AS words FROM part")
def q_keyword_filter(spark, sf_dir):
    """O-10."""
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(text.drop_keywords(F.split("p_name", " "), ["Red", "green", "STEEL", "small"]), "|").alias("words"))


@query("""WITH w AS (SELECT c_custkey, lower(c_mktsegment) AS word FROM customer)
SELECT c_custkey, word FROM w WHERE word IN (SELECT lower(r_name) FROM region UNION ALL SELECT 'building' UNION ALL SELECT 'machinery')""")
def q_vocabulary(spark, sf_dir):
    """O-11."""
    from quarry.sources.readers import in_vocabulary

    known = read(spark, sf_dir, "region").select(F.lower("r_name").alias("word"))
    known = known.unionByName(spark.createDataFrame([("building",), ("machinery",)], "word string"))
    words = read(spark, sf_dir, "customer").select("c_custkey", F.lower("c_mktsegment").alias("word"))
    return in_vocabulary(words, known)


@query("""SELECT page_id, trim(translate(replace('Edit:' || chr(10) || chr(9) || ' <{{{}}}> ', '{{{}}}', url), chr(10) || chr(9), '')) AS filled,
trim(replace('` say' || chr(10) || url || ' ``', chr(10), ''), '` ') AS answer, replace('it''s ' || url, '''', '') AS plain,
url || '. pure background. high quality, very detailed. 8k.' AS extraction, replace(split_part(replace(url, 'https:/', ''), '.', 1), '/', '_') AS style_task FROM pages""")
def q_text_forms(spark, sf_dir):
    """O-25, O-26, O-27, O-33, O-35, O-37."""
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", text.fill("Edit:\n\t <{{{}}}> ", url).alias("filled"), text.clean_response(F.concat(F.lit("` say\n"), url, F.lit(" ``"))).alias("answer"),
        text.without_apostrophes(F.concat(F.lit("it's "), url)).alias("plain"), text.extraction_prompt(url).alias("extraction"), text.task_id(url, "https:").alias("style_task"),
    )


def _said(kind):
    """A response with the parts of its kind: some with commas, some with a last full stop."""
    names = parse.FIELDS[kind]
    parts = [f"'{n}: a {n} ' || n_name || CASE WHEN n_regionkey = {k} THEN '.' ELSE '' END" for k, n in enumerate(names)]
    return " || CASE WHEN n_nationkey % 2 = 0 THEN ', ' ELSE ' ' END || ".join(parts)


def _parsed_sql():
    columns = []
    for kind, names in parse.FIELDS.items():
        regex = "^" + ",?\\s*".join(f"{n}:\\s*(.*?)" for n in names) + "\\s*$"
        for k, n in enumerate(names):
            columns.append(f"rtrim(trim(regexp_extract({_said(kind)}, '{regex}', {k + 1})), '.') AS {kind}_{n}")
    return f"SELECT n_nationkey AS key, {', '.join(columns)} FROM nation"


@query(_parsed_sql())
def q_parse_kinds(spark, sf_dir):
    """O-29 to O-32: every kind of response."""
    rows = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), *[parse.response(F.expr(_said(k)), k).alias(k) for k in parse.FIELDS])
    return rows.select("key", *[F.col(f"{k}.{n}").alias(f"{k}_{n}") for k, names in parse.FIELDS.items() for n in names])


_SCORED = "CASE s_suppkey % 4 WHEN 0 THEN '[' || s_nationkey || '.25]' WHEN 1 THEN s_nationkey || '.5' WHEN 2 THEN 'none' END"


@query(f"SELECT s_suppkey, TRY_CAST(trim(x, '[]') AS DOUBLE) AS score FROM (SELECT s_suppkey, {_SCORED} AS x FROM supplier)")
def q_scalar_scores(spark, sf_dir):
    """O-43: a number, a list of one, neither, and null."""
    return read(spark, sf_dir, "supplier").select("s_suppkey", parse.scalar_score(F.expr(_SCORED)).alias("score"))


_BOX = "'[' || round_even(x1, 0)::BIGINT || ',' || round_even(y1, 0)::BIGINT || ',' || round_even(x2, 0)::BIGINT || ',' || round_even(y2, 0)::BIGINT || ']'"
_SIZE = "height::BIGINT || 'x' || width::BIGINT"


@query(f"""WITH {_with('img', 'obj')}, t AS (SELECT o.*, edit_type AS cap, class_name AS n, {_BOX} AS b, {_SIZE} AS s FROM obj o JOIN img USING (image_id))
SELECT image_id, idx, pk, sk, qty, 'summary: ' || cap || ', background: ''' || n || '''object in background: ''a, b''.' AS background,
'caption: ' || cap || ', resolution: ' || s || ', object: ''' || n || ''', object bbox: ' || b || ', instructions: [''add'', ''adjust'']' AS turns,
'caption: ' || cap || ' object: ''' || n || ''', resolution: ' || s || ', object bbox: ' || b || '.' AS added,
'caption: ' || cap || ' object to remove: ''' || n || '''' || CASE WHEN idx % 2 = 0 THEN '.' ELSE ', resolution: ' || s || ', object bbox: ' || b END AS removed,
'sence: ' || cap || ', resolution: ' || s || ', object1: ''' || n || ''', bbox1: ' || b || ', instruction1: ''add'', object2: ''sky'', bbox2: ' || b || ', instruction2: ''remove''.' AS hybrid,
'sence: ' || cap || ', object1: ''' || n || ''', instruction1: ''add'', object2: ''sky'', instruction2: ''remove''.' AS memory FROM t""")
def q_descriptions(spark, sf_dir):
    """O-34b to O-34h."""
    rows = view(spark, sf_dir, "obj").join(view(spark, sf_dir, "img"), "image_id")
    cap, name, size = F.col("edit_type"), F.col("class_name"), describe.size_text(F.col("height"), F.col("width"))
    box, names, operations = describe.box_text(F.array("x1", "y1", "x2", "y2")), [F.col("class_name"), F.lit("sky")], [F.lit("add"), F.lit("remove")]
    return rows.select(
        "image_id", *TIES, describe.background(cap, name, _lit(["a", "b"])).alias("background"),
        describe.multi_turn(cap, name, size, box, _lit(["add", "adjust"])).alias("turns"), describe.addition(cap, name, size, box).alias("added"),
        describe.removal(cap, name, size, F.when(F.col("idx") % 2 == 1, box)).alias("removed"),
        describe.two_objects(cap, names, [box, box], operations, size).alias("hybrid"), describe.two_objects(cap, names, None, operations).alias("memory"),
    )


@query(f"""WITH {_with('obj')} SELECT a.image_id, a.idx, a.pk, a.sk, a.qty, (a.class_name <> b.class_name AND {_far_sql('a', 'b')}) AS usable
FROM obj a, (SELECT 'AF' AS class_name, 0.0::DOUBLE AS x1, 0.0::DOUBLE AS y1, 90.0::DOUBLE AS x2, 90.0::DOUBLE AS y2) b""")
def q_usable_pairs(spark, sf_dir):
    """O-17, O-18: each box beside a fixed one."""
    other = F.struct(F.lit("AF").alias("class_name"), *[F.lit(v).alias(c) for c, v in (("x1", 0.0), ("y1", 0.0), ("x2", 90.0), ("y2", 90.0))])
    return view(spark, sf_dir, "obj").select("image_id", *TIES, geometry.usable_pair(F.struct("class_name", "x1", "y1", "x2", "y2"), other).alias("usable"))


def _odd_sql(seed):
    return f"strpos('13579bdf', substr(md5(concat_ws(':', image_id, '{seed}')), 1, 1)) > 0"


@query(f"""WITH {_with('img')}, d AS (SELECT image_id, o, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws(':', image_id, o, i, '{SEED}'))) AS rn
FROM img, (VALUES (0, 'a'), (1, 'b'), (2, 'c'), (3, 'd'), (4, 'e'), (5, 'f')) v(i, o)), s AS (SELECT image_id, string_agg(o, ',' ORDER BY rn) AS many FROM d WHERE rn <= 5 GROUP BY image_id)
SELECT image_id, CASE WHEN {_odd_sql(SEED)} THEN 'replace' ELSE 'adjust' END || ',' || CASE WHEN {_odd_sql(SEED + 1)} THEN 'replace' ELSE 'adjust' END AS two,
CASE WHEN {_odd_sql(SEED)} THEN 'add,adjust,remove' ELSE 'add,adjust,replace' END AS turns, many, 'a,b' AS few FROM img JOIN s USING (image_id)""")
def q_draws(spark, sf_dir):
    """O-66, O-67, O-68."""
    key = F.col("image_id").cast("string")
    drawn = {"two": sample.two_draws(key, SEED), "turns": sample.understand_order(key, SEED), "many": sample.some_of(_lit("abcdef"), 5, SEED, key), "few": sample.some_of(_lit("ab"), 5, SEED, key)}
    return view(spark, sf_dir, "img").select("image_id", *[F.array_join(c, ",").alias(n) for n, c in drawn.items()])


@query("""WITH t AS (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, array_to_string(list_filter([CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END], lambda x: x IS NOT NULL), ',') AS lacking FROM t""")
def q_valid_tasks(spark, sf_dir):
    """O-13, O-19, O-94: rows with all fields, and the rest with what they lack."""
    joined = read(spark, sf_dir, "documents").select("doc_id").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    good, bad = resume.valid(joined.select("doc_id", "quality", "toxic"), ["quality", "toxic"])
    return good.select("doc_id", F.lit("").alias("lacking")).unionByName(bad.select("doc_id", F.array_join("missing_fields", ",").alias("lacking")))


@query("""SELECT p_partkey, (contains(p_type || ' ' || p_name, string_split(p_name, ' ')[1]) AND contains(p_type || ' ' || p_name, p_brand)) AS in_caption,
len(string_split(p_name, ' ')) <= 2 AS is_short, CASE WHEN p_size % 3 = 0 THEN p_size % 2 = 0 ELSE p_size % 2 <> 0 END AS noun, NOT (contains(p_name, p_brand) OR contains(p_type, p_brand)) AS fresh,
(p_size % 5 <= p_size % 7 AND p_size % 3 <= p_size % 7) AS consistent FROM part""")
def q_text_rules(spark, sf_dir):
    """O-95 to O-101."""
    part, size = read(spark, sf_dir, "part"), F.col("p_size")
    caption = F.concat_ws(" ", "p_type", "p_name")
    return part.select(
        "p_partkey", text.all_in_caption(F.array(F.split("p_name", " ")[0], F.col("p_brand")), caption).alias("in_caption"), text.at_most_words(F.col("p_name"), 2).alias("is_short"),
        text.noun_or_none(F.when(size % 3 == 0, "add").otherwise("adjust"), F.when(size % 2 == 0, "None").otherwise("Chair")).alias("noun"),
        text.premise_not_repeated(F.col("p_brand"), [F.col("p_name"), F.col("p_type")]).alias("fresh"), parse.scores_consistent(F.array(size % 7, size % 5, size % 3)).alias("consistent"),
    )


_KINDS = ["add", "remove", "replace", "adjust", "background", "extract", "style", "other"]


@query("""WITH t AS (SELECT o_orderkey, ['add', 'remove', 'replace', 'adjust', 'background', 'extract', 'style', 'other'][o_orderkey % 8 + 1] AS kind, 'it''s ' || o_orderpriority AS said FROM orders)
SELECT o_orderkey, CASE kind WHEN 'add' THEN 'sdxl_inpaint' WHEN 'remove' THEN 'sdxl_inpaint' WHEN 'replace' THEN 'flux_inpaint' WHEN 'adjust' THEN 'sdxl_adjust'
 WHEN 'background' THEN 'flux_inpaint' WHEN 'extract' THEN 'extract_ref' WHEN 'style' THEN 'sdxl_style_transfer_ghibli' END AS template,
CASE WHEN kind IN ('add', 'remove') THEN 'empty, emptiness, blank, vacent' WHEN kind = 'style' THEN 'Studio Ghibli, hand-drawn animation style, masterpiece, high score.'
 WHEN kind = 'extract' THEN replace(said, '''', '') || '. pure background. high quality, very detailed. 8k.' ELSE replace(said, '''', '') END AS prompt,
CASE WHEN kind IN ('add', 'remove') THEN 'empty, emptiness, blank' ELSE replace(said, '''', '') END AS turn_prompt, kind = 'add' AS swapped, CASE WHEN kind = 'other' THEN 'unknown kind' END AS error FROM t""")
def q_single_edits(spark, sf_dir):
    """O-38, O-58 to O-59: template and prompt by kind; and the prompts of turns."""
    kind, said = F.get(_lit(_KINDS), (F.col("o_orderkey") % 8).cast("int")), F.concat(F.lit("it's "), "o_orderpriority")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", kind.alias("kind"), said.alias("edit_result"))
    rows = tasks.single_edits(rows).withColumn("turn_prompt", tasks.turn_prompt(F.col("kind"), F.col("edit_result")))
    return rows.select("o_orderkey", "template", "prompt", "turn_prompt", "swapped", "error")


@query("""WITH t AS (SELECT o_orderkey, o_orderkey % 4 AS n, o_custkey % 3 AS way FROM orders)
SELECT o_orderkey, CASE WHEN way = 2 THEN CASE n WHEN 0 THEN 'add_omit' WHEN 1 THEN 'replace_version' WHEN 2 THEN 'adjust_version' END
 ELSE CASE n WHEN 0 THEN 'add_omit' WHEN 1 THEN 'adjust_omit' WHEN 2 THEN CASE way WHEN 0 THEN 'remove_omit' ELSE 'replace_omit' END END END AS driver,
CASE WHEN n < 3 THEN n END::BIGINT AS turn, CASE WHEN n < 3 THEN 'original' END AS source, CASE WHEN n < 3 THEN n = 2 END AS last FROM t""")
def q_three_turns(spark, sf_dir):
    """O-21, O-60: the drivers of three turns; n turns have a result."""
    orders, n, way = read(spark, sf_dir, "orders"), (F.col("o_orderkey") % 4).cast("int"), F.col("o_custkey") % 3
    first, second = sample.UNDERSTAND
    operations = F.when(way == 2, _lit(sample.BACKTRACK)).when(way == 0, _lit(first)).otherwise(_lit(second))
    done = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    drivers = [t.driver for t in tasks.TURNS if t.driver.endswith(("_omit", "_version"))]
    return orders.select("o_orderkey", tasks.ready_turn(operations, done, drivers).alias("next")).select("o_orderkey", "next.*")


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Prompt Compliance|Visual Naturalness|Physical & Detail Integrity'
 WHEN 'MACHINERY' THEN 'Style Fidelity|Content Preservation|Rendering Quality' END AS lines, 'sky|sea|' || c_mktsegment AS labels FROM customer""")
def q_rubric_lines(spark, sf_dir):
    """O-41, O-73."""
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "replace").when(F.col("c_mktsegment") == "MACHINERY", "style").otherwise("unknown")
    labels = text.label_list(_lit(["sky", "sea"]), F.array("c_mktsegment"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.array_join(scores.rubric_lines(kind), "|").alias("lines"), F.array_join(labels, "|").alias("labels"))


@query(f"""WITH {_with('img')} SELECT count(*) AS total, count(*) FILTER (aes > 4.75 AND height > 512 AND width > 512) AS kept,
count(*) FILTER (NOT (aes > 4.75 AND height > 512 AND width > 512)) AS dropped FROM img""")
def q_filter_report(spark, sf_dir):
    """O-57."""
    return scores.report(view(spark, sf_dir, "img"), (F.col("aes") > 4.75) & (F.col("height") > 512) & (F.col("width") > 512))


@query(f"""WITH {_with('obj')}, b AS (SELECT image_id, class_name, count(*) AS n, max(score) AS best FROM obj GROUP BY ALL)
SELECT image_id, class_name, n, best, CASE WHEN class_name IN ('AF', 'NO') THEN 'object' WHEN class_name IN ('RF', 'AO') THEN 'background' END AS kind FROM b""")
def q_detected_classes(spark, sf_dir):
    """O-36, O-54, O-87: classes of an image's detections with their kinds."""
    rows = view(spark, sf_dir, "obj").groupBy("image_id", "class_name").agg(F.count("*").alias("n"), F.max("score").alias("best"))
    return rows.withColumn("kind", detect.class_kind(F.col("class_name"), _lit(["AF", "NO"]), _lit(["RF", "AO"])))


@query(f"""WITH {_with('obj')}, o AS (SELECT *, row_number() OVER () AS u FROM obj)
SELECT a.image_id, sum(CASE WHEN a.u < b.u AND a.class_name <> b.class_name AND {_far_sql('a', 'b')} THEN 1 ELSE 0 END)::BIGINT AS n
FROM o a JOIN o b USING (image_id) GROUP BY a.image_id""")
def q_far_pair_counts(spark, sf_dir):
    """O-17, O-18: all usable pairs of an image, counted and not listed; there is no cut of its boxes."""
    return detect.usable_pair_counts(view(spark, sf_dir, "obj"))


_OPERATIONS = "['add', 'remove', 'replace', 'adjust']"


@query(f"""WITH t AS (SELECT DISTINCT conv_id, {_OPERATIONS}[conv_id % 4 + 1] AS op0, {_OPERATIONS}[conv_id // 4 % 4 + 1] AS op1 FROM conversations WHERE conv_id IS NOT NULL)
SELECT conv_id AS task_id, 0::BIGINT AS turn, 'compose_' || op0 AS driver, 'original' AS source, false AS last FROM t
UNION ALL SELECT conv_id, 1, 'compose_' || op1, 'result_0', true FROM t""")
def q_all_turns(spark, sf_dir):
    """O-60: tasks of two operations, run to their last turn."""
    names = _lit(sample.OPERATIONS)
    operations = F.array(F.get(names, F.col("conv_id") % 4), F.get(names, F.floor(F.col("conv_id") / 4) % 4))
    todo = read(spark, sf_dir, "conversations").select("conv_id").distinct().select(F.col("conv_id").alias("task_id"), operations.alias("operations"))
    made = tasks.run_turns(todo, new_folder(spark, "turns"), lambda df: df, [f"compose_{o}" for o in sample.OPERATIONS])
    return made.select("task_id", "turn", "driver", "source", "last")


@query("""SELECT CAST(doc_id AS VARCHAR) AS key, doc_id, lang, n_chars, md5(text) AS digest, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE md5(text) END AS answer,
CASE WHEN doc_id % 3 = 0 THEN concat('failed: "', lang, '"') END AS error FROM documents WHERE doc_id IS NOT NULL""")
def q_json_documents(spark, sf_dir):
    """O-1, O-5, O-74, O-78: all documents as one map and as one array, and results with errors, written and read by byte ranges."""
    folder, docs = new_folder(spark, "json"), read(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    writers.json_document(docs.select(F.col("doc_id").cast("string").alias("key"), "doc_id", "lang"), f"{folder}/map.json", "key")
    writers.json_document(docs.select("doc_id", "n_chars", "text"), f"{folder}/list.json")
    failed = F.col("doc_id") % 3 == 0
    told = docs.select(F.col("doc_id").cast("string").alias("key"), F.when(~failed, F.col("text")).alias("text"), F.when(failed, F.concat(F.lit('failed: "'), "lang", F.lit('"'))).alias("error"))
    writers.as_result_map(told, f"{folder}/results.json")
    keyed = readers.keyed_items(spark, f"{folder}/map.json", "struct<doc_id:bigint,lang:string>")
    listed = readers.json_array(spark, f"{folder}/list.json", "doc_id long, n_chars long, text string").select("doc_id", "n_chars", F.md5("text").alias("digest"))
    results = readers.result_map(spark, f"{folder}/results.json").select("key", F.md5("text").alias("answer"), "error")
    return keyed.join(listed, "doc_id").join(results, "key")


_MASK = "p_size % 5 + 3"


@query(f"SELECT p_partkey, ({_MASK}) * (p_size % 3 + 1) AS area, ({_MASK} + 4) * 8 - ({_MASK}) * (p_size % 3 + 1) AS outside, 4 * ({_MASK}) * (p_size % 3 + 1) AS doubled FROM part")
def q_mask_areas(spark, sf_dir):
    """O-44, O-45, O-46: boxes drawn as pixels, as runs, turned inside out, and at twice the size."""
    high, wide = F.expr(f"CAST({_MASK} AS INT)"), F.expr("CAST(p_size % 3 + 1 AS INT)")
    height, width = high + 4, F.lit(8)
    row = F.concat(F.lit("00" * 2), F.repeat(F.lit("01"), wide), F.repeat(F.lit("00"), 6 - wide))
    pixels = F.unhex(F.concat(F.repeat(F.lit("00" * 8), F.lit(1)), F.repeat(row, high), F.repeat(F.lit("00" * 8), F.lit(3))))
    text = masks.encode_mask(pixels, height, width)
    drawn = read(spark, sf_dir, "part").select("p_partkey", text.alias("m"), height.alias("h"), width.alias("w"))
    sized = drawn.withColumn("big", masks.resize_mask("m", "h", "w", F.col("h") * 2, F.col("w") * 2)).withColumn("region", masks.edit_region("m", "h", "w"))
    outside = F.length(F.replace(F.hex("region"), F.lit("00"), F.lit(""))) / 2
    return sized.select("p_partkey", masks.mask_area("m").alias("area"), outside.cast("long").alias("outside"), masks.mask_area("big").alias("doubled"))


_SPOT = "l_linenumber * 4 AS x1, l_partkey % 20 AS y1, l_linenumber * 4 + 6 AS x2, l_partkey % 20 + 1 + l_suppkey % 25 AS y2"


@query(f"""WITH b AS (SELECT l_partkey, {_SPOT} FROM lineitem),
p AS (SELECT DISTINCT l_partkey, x, y FROM (SELECT *, unnest(range(x1, x2)) AS x FROM b), LATERAL (SELECT unnest(range(y1, least(y2, 40))) AS y) WHERE x < 32)
SELECT l_partkey, count(*) AS area, min(x) AS x1, min(y) AS y1, max(x) + 1 AS x2, max(y) + 1 AS y2 FROM p GROUP BY l_partkey""")
def q_mask_unions(spark, sf_dir):
    """O-44: masks of boxes, united for each part without drawing a pixel; its area and box. The boxes are cut to 40 by 32."""
    spots = read(spark, sf_dir, "lineitem").selectExpr("l_partkey", *_SPOT.split(", "))
    drawn = spots.select("l_partkey", runs.box_mask("x1", "y1", "x2", "y2", F.lit(40), F.lit(32)).alias("m"))
    made = runs.union_by(drawn, ["l_partkey"], "m").select("l_partkey", masks.mask_area("m").alias("area"), runs.mask_box("m", F.lit(40)).alias("b"))
    return made.select("l_partkey", "area", *[F.col("b")[k].alias(c) for k, c in enumerate(("x1", "y1", "x2", "y2"))])


_TWO = "p_size % 7 AS a1, p_size % 7 + 9 AS a2, p_partkey % 11 AS b1, p_partkey % 11 + 5 AS b2"


@query(f"""WITH t AS (SELECT p_partkey, {_TWO} FROM part), c AS (SELECT *, greatest(0, least(a2, b2) - greatest(a1, b1)) AS met FROM t)
SELECT p_partkey, (9 * 9 + 5 * 5 - met * met)::BIGINT AS either, (met * met)::BIGINT AS common, (81 - met * met)::BIGINT AS only_first, met * met / (106 - met * met)::DOUBLE AS overlap,
(4 * met * met)::BIGINT AS doubled, a1 = 0 OR a2 = 16 AS at_border FROM c""")
def q_mask_pairs(spark, sf_dir):
    """O-44, O-46: two square masks of each part: together, shared, apart, overlap, twice the size, at the border (16 by 16)."""
    t = read(spark, sf_dir, "part").selectExpr("p_partkey", *_TWO.split(", "))
    side = F.lit(16)
    pair = t.select("p_partkey", runs.box_mask("a1", "a1", "a2", "a2", side, side).alias("a"), runs.box_mask("b1", "b1", "b2", "b2", side, side).alias("b"))
    made = pair.withColumn("both", runs.mask_intersection("a", "b"))
    return made.select(
        "p_partkey", masks.mask_area(runs.mask_union("a", "b")).alias("either"), masks.mask_area("both").alias("common"), masks.mask_area(runs.mask_difference("a", "b")).alias("only_first"),
        runs.mask_overlap("a", "b").alias("overlap"), masks.mask_area(runs.mask_resized("both", side, side, side * 2, side * 2)).alias("doubled"),
        runs.mask_touches_border("a", side, side).alias("at_border"),
    )


class _Sizes:
    """A detector's stand-in: one box for each label, as wide as the image has bytes; a page of 7 labels breaks the call."""

    def __call__(self, contents, labels):
        if any(len(names) == 7 for names in labels):
            raise ValueError("broken image")
        return [[{"class_name": c, "bbox": [0.0, 0.0, float(len(data)), 1.0], "score": 0.5, "mask": None} for c in names] for data, names in zip(contents, labels)]


@query("""SELECT page_id, CASE WHEN page_id % 8 <> 7 THEN page_id % 8 END AS n, CASE WHEN page_id % 8 NOT IN (0, 7) THEN strlen(html)::DOUBLE END AS width,
CASE WHEN page_id % 8 = 7 THEN 'broken image' END AS error FROM pages""")
def q_batched_boxes(spark, sf_dir):
    """O-86: pages as images of five heights, detected in batches of one height; a broken one leaves its batch alone."""
    names = F.when(F.col("page_id") % 8 > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.col("page_id") % 8), lambda k: k.cast("string")))
    pages = read(spark, sf_dir, "pages").select("page_id", F.encode("html", "utf-8").alias("content"), names.alias("labels"), (F.col("page_id") % 5).alias("height"))
    found = batches.detected_in_batches(pages, pacing.once_a_worker("sizes", _Sizes), shape=("height",))
    return found.select("page_id", F.when(F.col("error").isNull(), F.size("boxes").cast("long")).alias("n"), F.get("boxes", F.lit(0))["bbox"][2].alias("width"), "error")


@query(f"WITH {_with('img')} SELECT count(*) AS total, count(*) FILTER (aes > 4.75 AND height > 512 AND width > 512) AS kept, count(*) FILTER (NOT (aes > 4.75 AND height > 512 AND width > 512)) AS dropped FROM img")
def q_counted_filter(spark, sf_dir):
    """O-57: a filter's report, counted while its rows are written; the report is one row, made of three numbers."""
    kept, watch = scores.counted_as_written(view(spark, sf_dir, "img"), F.expr("aes > 4.75D AND height > 512 AND width > 512"))
    kept.write.parquet(new_folder(spark, "kept"))
    return spark.createDataFrame([tuple(watch.get[c] for c in ("total", "kept", "dropped"))], "total long, kept long, dropped long")


@query("""WITH o AS (SELECT DISTINCT conv_id, ['add', 'remove', 'replace', 'adjust'] AS ops FROM conversations), t AS (SELECT conv_id, unnest([0, 1]) AS turn, ops FROM o)
SELECT conv_id::VARCHAR AS task_id, turn::BIGINT AS turn, 'compose_' || ops[CASE WHEN turn = 0 THEN conv_id % 4 ELSE conv_id // 4 % 4 END + 1] AS driver,
CASE WHEN turn = 0 THEN 'original' ELSE 'result_0' END AS source, turn = 1 AS last, concat(conv_id, '-', turn) AS image FROM t""")
def q_stream_turns(spark, sf_dir):
    """O-60: tasks of two operations, as many as conversations, run to their end by the stream; each turn has one result."""
    folder = new_folder(spark, "turns")
    names = _lit(sample.OPERATIONS)
    ids = read(spark, sf_dir, "conversations").select("conv_id").distinct()
    ids.select(F.col("conv_id").cast("string").alias("task_id"), F.array(F.get(names, F.col("conv_id") % 4), F.get(names, F.floor(F.col("conv_id") / 4) % 4)).alias("operations")).write.parquet(f"{folder}/tasks")
    edit = lambda df: df.withColumn("image", F.concat("task_id", F.lit("-"), F.col("next.turn")))
    stream = follow_turns(spark, f"{folder}/tasks", "task_id string, operations array<string>", f"{folder}/results", edit, "image string", f"{folder}/state", [f"compose_{o}" for o in sample.OPERATIONS])
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return spark.read.parquet(f"{folder}/results").where("NOT failed").select("task_id", "turn", "driver", "source", "last", "image")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)
AND NOT (o_orderstatus = 'O' AND o_orderkey % 2 = 0)""")
def q_indexed_resume(spark, sf_dir):
    """O-20, O-76: orders without an output, by the index of two versions of outputs: of orders with a returned item, and of even open ones."""
    root, orders = new_folder(spark, "outputs"), read(spark, sf_dir, "orders")
    versions.add_version(read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), root, 0, "o_orderkey")
    versions.add_version(orders.where("o_orderstatus = 'O' AND o_orderkey % 2 = 0").select("o_orderkey", "o_orderdate"), root, 1, "o_orderkey")
    return versions.missing_in_versions(orders.select("o_orderkey"), root, "o_orderkey")


def _lot_sql(side, row):
    return f"md5(concat_ws(':', {row}.image_id, {row}.idx, {row}.pk, {row}.sk, 0, '{side}', '{SEED}'))"


_ROW = "idx, pk, sk, class_name, x1, y1, x2, y2"


@query(f"""WITH {_with('obj')}, o AS (SELECT *, row_number() OVER () AS u FROM obj),
p AS (SELECT a.u AS au, b.u AS bu FROM o a JOIN o b USING (image_id) WHERE a.class_name <> b.class_name AND {_far_sql('a', 'b')}),
w AS (SELECT au, count(*) AS n FROM p GROUP BY au),
f AS (SELECT o.*, row_number() OVER (PARTITION BY image_id ORDER BY -ln((('0x' || substr({_lot_sql('first', 'o')}, 1, 12))::BIGINT + 0.5) / 281474976710656.0) / n, {_ROW}) AS rn FROM o JOIN w ON u = au),
s AS (SELECT f.image_id, f.idx AS first_idx, f.pk AS first_pk, f.sk AS first_sk, o.idx AS second_idx, o.pk AS second_pk, o.sk AS second_sk,
 row_number() OVER (PARTITION BY f.image_id ORDER BY {_lot_sql('second', 'o')}, {', '.join('o.' + c for c in _ROW.split(', '))}) AS rn
 FROM f JOIN p ON f.u = au JOIN o ON o.u = bu WHERE rn = 1)
SELECT * EXCLUDE (rn) FROM s WHERE rn = 1""")
def q_drawn_pairs(spark, sf_dir):
    """O-17, O-18: one of all usable pairs of each image, each as likely as another; there is no cut of its boxes."""
    drawn = detect.drawn_pairs(view(spark, sf_dir, "obj"), 1, SEED, ties=("idx", "pk", "sk"))
    return drawn.select("image_id", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("first", "second") for c in ("idx", "pk", "sk")])


def _words_sql(t):
    return f"list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def _among(ws):
    return "(" + ", ".join(f"'{w}'" for w in ws) + ")"


_SAID = [
    "concat('Make the ', p_type)", "concat('change it, ', lower(p_name), ' of old')", "concat('put a ', split_part(p_name, ' ', 1), ' ', p_type)", "concat(p_brand, ' and ', p_name)",
]
_ROUND = "CASE p_partkey % 4 " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(_SAID)) + " END"
_SHOWN = "CASE p_size % 5 WHEN 0 THEN 'None' WHEN 1 THEN concat('a ', p_name) WHEN 2 THEN concat('It is ', p_type) WHEN 3 THEN concat(split_part(p_name, ' ', 1), ' box') ELSE concat('Replace ', p_brand) END"


@query(f"""WITH t AS (SELECT p_partkey, {_words_sql('p_name')} AS p, {_words_sql(_ROUND)} AS r, {_words_sql(_SHOWN)} AS s, {_SHOWN} AS said, p_size % 3 = 0 AS adds FROM part),
k AS (SELECT *, least(3, len(p)) AS n, list_distinct(list_filter(p, lambda w: w NOT IN {_among(text.PLAIN)})) AS telling FROM t)
SELECT p_partkey, CASE WHEN adds THEN lower(said) = 'none' ELSE len(s) BETWEEN 1 AND 8 AND s[1] NOT IN {_among(text.ORDERS)} AND s <> ['none'] AND len(list_filter(s, lambda w: w IN {_among(text.SENTENCE)})) = 0 END AS named,
NOT (n > 0 AND len(list_filter(range(1, len(p) - n + 2), lambda i: contains(concat(' ', array_to_string(r, ' '), ' '), concat(' ', array_to_string(p[i:i + n - 1], ' '), ' ')))) > 0) AS fresh,
2 * len(list_intersect(telling, s)) >= len(telling) AS reflected FROM k""")
def q_premises(spark, sf_dir):
    """O-98, O-99: results that name an object, and premises that rounds leave unsaid and results show."""
    op = F.when(F.col("p_size") % 3 == 0, "add").otherwise("adjust")
    said, shown = F.expr(_ROUND), F.expr(_SHOWN)
    kept = text.premise_kept(F.col("p_name"), [said], [shown])
    return read(spark, sf_dir, "part").select("p_partkey", text.result_named(op, shown).alias("named"), kept.alias("kept")).select("p_partkey", "named", "kept.*")
