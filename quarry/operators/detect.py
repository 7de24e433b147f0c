"""Clean-up of detections: confidence, top-k, greedy suppression, classes and counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.names import unused
from quarry.operators.geometry import MIN_GAP, far_apart, usable_pair
from quarry.operators.partition import written
from quarry.operators.sample import lot

TOP_K, MIN_SCORE, MAX_OVERLAP = 100, 0.005, 0.5
#: Boxes of an image that are folded in one row; the least overlap for which larger images are spread over tasks; the side
#: of the cells in which boxes near each other meet; and the parts of an image in which a drawn box looks for its second.
FOLD_BOXES, LEAST_OVERLAP, CELL, SALTS = 1000, 0.1, 256.0, 16
#: Boxes of an image whose pairs are looked at in one row; those of larger images meet in cells.
PAIR_BOXES = 256


def confident(boxes: DataFrame, least: float = MIN_SCORE) -> DataFrame:
    """O-16: strictly above."""
    return boxes.where(F.col("score") > least)


def top_k(boxes: DataFrame, k: int = TOP_K, image: str = "image_id", ties: tuple[str, ...] = ("idx",)) -> DataFrame:
    """O-62: the k best of each image. Spark cuts every task's rows to k an image before they are shuffled."""
    best = Window.partitionBy(image).orderBy(F.col("score").desc(), *ties)
    return boxes.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two structs with x1, y1, x2, y2."""
    none = F.lit(0.0)
    dx = F.greatest(none, F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    dy = F.greatest(none, F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    both = dx * dy
    area = lambda x: (x["x2"] - x["x1"]) * (x["y2"] - x["y1"])
    return F.try_divide(both, area(a) + area(b) - both)


def suppress(
    boxes: DataFrame, most: float = MAX_OVERLAP, image: str = "image_id", ties: tuple[str, ...] = ("idx",), fold_boxes: int = FOLD_BOXES
) -> DataFrame:
    """O-61: by falling score, a box stays unless it overlaps one that stays by more than most.

    Images of up to fold_boxes boxes are folded in a row each; the boxes of larger ones are spread over tasks. Where most is
    below LEAST_OVERLAP, boxes of any sizes can suppress each other and all images are folded.
    """
    if most < LEAST_OVERLAP or most >= 1:
        return _folded(boxes, most, image, ties)
    few, many = _by_size(boxes, image, fold_boxes)
    folded = _folded(few, most, image, ties)
    return folded if many is None else folded.unionByName(_in_rounds(many, most, image, ties))


def _by_size(boxes: DataFrame, image: str, fold_boxes: int) -> tuple[DataFrame, DataFrame | None]:
    """The boxes of images of up to fold_boxes boxes, and those of larger ones; None where no image is larger."""
    (key,) = unused(boxes, "_image")
    large = written(boxes.groupBy(F.col(image).alias(key)).agg(F.count("*").alias("n")).where(F.col("n") > fold_boxes).select(key))
    if large.isEmpty():
        return boxes, None
    same = boxes[image].eqNullSafe(large[key])
    return boxes.join(large, same, "left_anti"), boxes.join(large, same, "left_semi")


def _in_rounds(boxes: DataFrame, most: float, image: str, ties: tuple[str, ...]) -> DataFrame:
    """suppress() for images of any number of boxes, in rounds: a box that no undecided better box overlaps stays, and those
    that it overlaps go. Pairs of overlapping boxes are found once; rounds go on until no pair is undecided."""
    uid, order = unused(boxes, "_uid", "_order")
    rest = [c for c in boxes.columns if c not in {image, "score", *ties}]
    ranked = boxes.withColumn(uid, F.monotonically_increasing_id())
    ranked = written(ranked.withColumn(order, F.struct((-F.col("score")).alias("s"), *ties, *[F.col(c) for c in rest], uid)))
    pairs = written(overlapping(ranked, most, image, uid, order))
    gone = None
    while not pairs.isEmpty():
        stay = pairs.select("better").join(pairs.select(F.col("worse").alias("better")), "better", "left_anti").distinct()
        go = written(pairs.join(stay, "better", "left_semi").select("worse").distinct())
        pairs = pairs.join(go, "worse", "left_anti").join(go.select(F.col("worse").alias("better")), "better", "left_anti")
        pairs, gone = written(pairs), go if gone is None else gone.unionByName(go)
    kept = ranked if gone is None else ranked.join(gone.select(F.col("worse").alias(uid)), uid, "left_anti")
    return kept.select(*boxes.columns)


def _side(level: Column) -> Column:
    """Side of the cells for boxes of this size."""
    return F.pow(F.lit(2.0), level + 1)


def _cells(wide: Column, centre: Column, most: float) -> Callable[[Column], Column]:
    """The cells of a level in which the centre of a box can lie that overlaps a box of this width by more than most."""

    def cells(level: Column) -> Column:
        reach = (1 - most) * F.greatest(wide, _side(level)) * (1 + 1e-9)
        places = F.sequence(F.floor((centre - reach) / _side(level)), F.floor((centre + reach) / _side(level)))
        return F.transform(places, lambda c: F.struct(level.alias("level"), c.alias("cell")))

    return cells


def overlapping(boxes: DataFrame, most: float, image: str, uid: str, order: str) -> DataFrame:
    """(better, worse): uids of boxes of an image that overlap by more than most, each pair once.

    Boxes that overlap so are alike in width and height up to a factor of 1 / most, and their centres are near. So a box
    lies in one cell of a grid for boxes of its size, and is looked for from the cells, in grids of sizes like its own, that
    the centre of a partner can lie in: an equality join, in which Spark splits cells of many boxes.
    """
    size = {"x": F.col("x2") - F.col("x1"), "y": F.col("y2") - F.col("y1")}
    solid = boxes.where((size["x"] > 0) & (size["y"] > 0))  # others overlap nothing
    box = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    a = b = solid.select(F.col(image).alias("image"), F.col(uid).alias("uid"), F.col(order).alias("order"), box.alias("box"))
    for axis in ("x", "y"):
        low, high = F.col(f"box.{axis}1"), F.col(f"box.{axis}2")
        wide, centre = high - low, (low + high) / 2
        level = F.floor(F.log2(wide)).cast("int")
        a = a.withColumn(f"level_{axis}", level).withColumn(f"cell_{axis}", F.floor(centre / _side(level)))
        levels = F.sequence(F.floor(F.log2(wide * most) - 1e-9).cast("int"), F.floor(F.log2(wide / most) + 1e-9).cast("int"))
        b = b.withColumn("at", F.explode(F.flatten(F.transform(levels, _cells(wide, centre, most))))).withColumn(f"level_{axis}", F.col("at.level")).withColumn(f"cell_{axis}", F.col("at.cell")).drop("at")
    grid = ["level_x", "cell_x", "level_y", "cell_y"]
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    meet = F.col("image").eqNullSafe(F.col("b_image"))
    for c in grid:
        meet = meet & (F.col(c) == F.col(f"b_{c}"))
    found = a.join(b, meet & (F.col("order") < F.col("b_order")) & (overlap(F.col("box"), F.col("b_box")) > most))
    return found.select(F.col("uid").alias("better"), F.col("b_uid").alias("worse"))


def _boxes(boxes: DataFrame, image: str, *more: str) -> DataFrame:
    """(image, class_name, corners, ...) of the boxes that can be in a pair: none of the corners and the class is null."""
    corners = ["x1", "y1", "x2", "y2"]
    return boxes.dropna(subset=["class_name", *corners]).select(F.col(image).alias("image"), "class_name", *[F.col(c).cast("double").alias(c) for c in corners], *more)


def _near(rows: DataFrame, gap: float, cell: float) -> DataFrame:
    """Pairs of different classes that are near each other, once each: image, and structs a and b with uid. Both meet in cells
    that they, widened by half the gap, touch, and count in the first of them."""
    corners = ["x1", "y1", "x2", "y2"]
    place = lambda x, way: F.floor((F.col(x) + way * (gap / 2 + 1e-6)) / cell)
    spread = rows.withColumn("cx", F.explode(F.sequence(place("x1", -1), place("x2", 1)))).withColumn("cy", F.explode(F.sequence(place("y1", -1), place("y2", 1))))
    a, b = (spread.select("image", "cx", "cy", F.struct("uid", "class_name", *corners).alias(k)) for k in "ab")
    a, b = written(a), b.select(*[F.col(c).alias(f"b_{c}") if c != "b" else F.col(c) for c in b.columns])
    x, y = F.col("a"), F.col("b")
    first = lambda c: F.floor((F.greatest(x[c], y[c]) - (gap / 2 + 1e-6)) / cell)  # noqa: E731  the first cell that both touch
    meet = F.col("image").eqNullSafe(F.col("b_image")) & (F.col("cx") == F.col("b_cx")) & (F.col("cy") == F.col("b_cy"))
    once = (F.col("cx") == first("x1")) & (F.col("cy") == first("y1")) & (x["uid"] < y["uid"])
    return a.join(b, meet & once & (x["class_name"] != y["class_name"]) & ~far_apart(x, y, gap)).select("image", "a", "b")


def usable_pair_counts(boxes: DataFrame, image: str = "image_id", gap: float = MIN_GAP, cell: float = CELL, fold_boxes: int = PAIR_BOXES) -> DataFrame:
    """O-17, O-18: (image, n): how many pairs of boxes of an image a two-object edit may take, without listing them.

    Images of up to fold_boxes boxes count in a row each, after one shuffle. In larger ones it is all pairs of different classes,
    from the numbers of each class, less those that are near each other, found in cells. Boxes with a null corner or class
    are in no pair.
    """
    whole = _boxes(boxes, image)
    few, many = _by_size(whole, "image", fold_boxes)
    arrays = few.groupBy("image").agg(F.collect_list(F.struct("class_name", "x1", "y1", "x2", "y2")).alias("boxes"))
    behind = F.transform("boxes", lambda x, i: F.size(F.filter("boxes", lambda y, j: (j > i) & usable_pair(x, y, gap))))
    out = arrays.select("image", F.aggregate(behind, F.lit(0).cast("long"), lambda n, k: n + k).alias("n"))
    if many is not None:
        out = out.unionByName(_spread_counts(many, gap, cell))
    return out.withColumnRenamed("image", image)


def _spread_counts(whole: DataFrame, gap: float, cell: float) -> DataFrame:
    """usable_pair_counts() for images of any number of boxes."""
    n = whole.groupBy("image", "class_name").agg(F.count("*").alias("n"))
    of = n.groupBy("image").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).cast("long").alias("pairs"))
    near = _near(whole.withColumn("uid", F.monotonically_increasing_id()), gap, cell)
    near = near.groupBy(F.col("image").alias("near_image")).agg(F.count("*").alias("near"))
    out = of.join(near, of["image"].eqNullSafe(near["near_image"]), "left")
    return out.select("image", (F.col("pairs") - F.coalesce("near", F.lit(0))).alias("n"))


def drawn_pairs(
    boxes: DataFrame, n: int = 1, seed: int = 7, image: str = "image_id", ties: tuple[str, ...] = ("idx",), gap: float = MIN_GAP, cell: float = CELL,
    fold_boxes: int = PAIR_BOXES,
) -> DataFrame:
    """O-17, O-18: (image, draw, first, second): n draws among all usable pairs of each image, each pair as likely as another.

    No box is cut and no pair is listed. How many partners a box has is counted; the first box is drawn by these numbers, in a race of
    lots, and the second evenly from the first's partners. Images of up to fold_boxes boxes do all this in a row each, after one
    shuffle. Those of larger ones count in cells, as in usable_pair_counts; their race is run by each task for itself before the
    shuffle, and the second is drawn in SALTS parts of an image. So a draw never fails: an image without a row has no usable
    pair. Draws may repeat each other. ties tell boxes of an image apart; boxes equal in all of them have one lot, and are drawn as one.
    """
    corners = ["x1", "y1", "x2", "y2"]
    tied = [f"tie_{k}" for k in range(len(ties))]
    rows = _boxes(boxes.withColumns({t: F.col(c) for t, c in zip(tied, ties)}), image, *tied)
    box = [*tied, "class_name", *corners]

    def chance(x, k: Column, side: str) -> Column:
        return lot(seed, "image", *[x[t] for t in tied], k, F.lit(side))

    def raced(x, k: int) -> Column:
        """The box with its lot in the race of draw k, in which it counts as often as it has partners."""
        part = (F.conv(F.substring(chance(x, F.lit(str(k)), "first"), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)  # in (0, 1)
        return F.struct((-F.ln(part) / x["partners"]).alias("_lot"), *[x[c].alias(c) for c in box])

    def second(x, draw: Column) -> Column:
        return F.struct(chance(x, draw.cast("string"), "second").alias("_lot"), *[x[c].alias(c) for c in box])

    few, many = _by_size(rows, "image", fold_boxes)
    drawn = _folded_draws(few, box, n, gap, raced, second)
    if many is not None:
        drawn = drawn.unionByName(_spread_draws(many, box, n, gap, cell, raced, second))
    named = lambda x: F.struct(*[x[t].alias(c) for t, c in zip(tied, ties)], *[x[c].alias(c) for c in ("class_name", *corners) if c not in ties])
    return drawn.select(F.col("image").alias(image), "draw", named(F.col("first")).alias("first"), named(F.col("second")).alias("second"))


def _folded_draws(rows: DataFrame, box: list[str], n: int, gap: float, raced: Callable[..., Column], second: Callable[..., Column]) -> DataFrame:
    """drawn_pairs() for images of few boxes: one array for each image holds its boxes."""
    whole = rows.groupBy("image").agg(F.collect_list(F.struct(*box)).alias("boxes"))
    partners = lambda x: F.filter("boxes", lambda y: usable_pair(x, y, gap))
    told = whole.withColumn("told", F.filter(F.transform("boxes", lambda x: x.withField("partners", F.size(partners(x)))), lambda x: x["partners"] > 0))
    winner = lambda k: F.array_min(F.transform("told", lambda x: raced(x, k)))
    drawn = told.select("image", "boxes", F.posexplode(F.array(*map(winner, range(n)))).alias("draw", "first")).where("first IS NOT NULL")
    return drawn.select("image", "draw", "first", F.array_min(F.transform(partners(F.col("first")), lambda x: second(x, F.col("draw")))).alias("second"))


def _spread_draws(
    rows: DataFrame, box: list[str], n: int, gap: float, cell: float, raced: Callable[..., Column], second: Callable[..., Column]
) -> DataFrame:
    """drawn_pairs() for images of any number of boxes."""
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()))
    own = rows.groupBy("image", "class_name").agg(F.count("*").alias("n"))
    total = own.groupBy(F.col("image").alias("total_image")).agg(F.sum("n").alias("total"))
    others = own.join(total, F.col("image").eqNullSafe(F.col("total_image")))
    others = others.select(F.col("image").alias("own_image"), F.col("class_name").alias("own_class"), (F.col("total") - F.col("n")).alias("others"))
    near = _near(rows, gap, cell).select(F.explode(F.array("a.uid", "b.uid")).alias("uid")).groupBy("uid").agg(F.count("*").alias("near"))
    told = rows.join(others, F.col("image").eqNullSafe(F.col("own_image")) & (F.col("class_name") == F.col("own_class"))).join(near, "uid", "left")
    told = told.withColumn("partners", F.col("others") - F.coalesce("near", F.lit(0))).where("partners > 0")
    own_row = {c: F.col(c) for c in [*box, "partners"]}
    race = [F.min(raced(own_row, k)).alias(f"draw_{k}") for k in range(n)]
    firsts = told.groupBy("image").agg(*race).select("image", F.posexplode(F.array(*[f"draw_{k}" for k in range(n)])).alias("draw", "first"))
    firsts = firsts.select(F.col("image").alias("first_image"), "draw", "first")
    firsts = firsts.withColumn("first_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")).withColumn("box", F.struct(*box))
    pairs = salted.join(firsts, F.col("image").eqNullSafe(F.col("first_image")) & (F.col("salt") == F.col("first_salt")))
    pairs = pairs.where(usable_pair(F.col("first"), F.col("box"), gap))
    return pairs.groupBy("image", "draw", "first").agg(F.min(second(own_row, F.col("draw"))).alias("second"))


def _folded(boxes: DataFrame, most: float, image: str, ties: tuple[str, ...]) -> DataFrame:
    """suppress() for images of few boxes: one array for each image holds its different boxes. Of exact copies all but the
    first go whatever becomes of it, so they go in every task before the shuffle."""
    corners = ["x1", "y1", "x2", "y2"]
    rest = [c for c in boxes.columns if c not in {image, "score", *ties}]
    box = F.struct((-F.col("score")).alias("_order"), *ties, "score", *rest)
    # a box without area overlaps nothing, itself included: its copies stay
    solid = F.coalesce((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")), F.lit(False)) & F.lit(most < 1)
    one = boxes.groupBy(image, *corners, F.when(~solid, box).alias("_flat")).agg(F.min(box).alias("_box"), F.count("*").cast("int").alias("_n"))
    stay = F.array_repeat("_box", F.when(F.col("_flat").isNull(), 1).otherwise(F.col("_n")))
    ranked = one.groupBy(image).agg(F.array_sort(F.flatten(F.collect_list(stay))).alias("_boxes"))
    kind = ranked.schema["_boxes"].dataType
    kept = F.aggregate(
        "_boxes",
        F.array().cast(kind),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.coalesce(overlap(x, y) > most, F.lit(False))), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return ranked.select(image, F.explode(kept).alias("_box")).select(*[image if c == image else f"_box.{c}" for c in boxes.columns])


def class_kind(name: Column, objects: Column, backgrounds: Column) -> Column:
    """O-54: object before background; null for a class in neither list."""
    return F.when(F.array_contains(objects, name), "object").when(F.array_contains(backgrounds, name), "background")


def counts(boxes: DataFrame, image: str = "image_id") -> DataFrame:
    """O-36: rows of each class in each image; summed in every task before the shuffle."""
    return boxes.groupBy(image, "class_name").agg(F.count("*").alias("n"))


def count_map(boxes: DataFrame, image: str = "image_id") -> DataFrame:
    """O-36 as a map; its size is the number of classes."""
    entries = F.array_sort(F.collect_list(F.struct("class_name", "n")))
    return counts(boxes, image).groupBy(image).agg(F.map_from_entries(entries).alias("counts"))
