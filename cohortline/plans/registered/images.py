"""Image steps over embeddings as 8 x 8 images, and image files over page addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import pixels as px
from ...operators import images as im
from ...operators import series as ser
from ...sources.files import filter_files
from .. import driver_tables as dt
from .registry import query

PIXELS = """
WITH px AS (
  SELECT vec_id AS image_id, (i - 1) AS idx, (i - 1) // 8 AS r, (i - 1) % 8 AS c, CAST(embedding[i] AS DOUBLE) AS v
  FROM embeddings, generate_series(1, 64) g(i)
), ends AS (SELECT image_id, min(v) AS lo, max(v) AS hi FROM px GROUP BY 1)
"""

BOX = """
, box AS (
  SELECT e.image_id, coalesce(min(r), 0) AS top, coalesce(min(c), 0) AS lft,
         coalesce(max(r) + 1, 0) AS bottom, coalesce(max(c) + 1, 0) AS rgt
  FROM ends e LEFT JOIN px ON px.image_id = e.image_id AND v > 0 AND v < hi GROUP BY 1
)"""


def _changed(change):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        images = dt.images(spark, sf_dir)
        return dt.pixel_rows(images.transform(im.on_image(change)))

    return run


@query(PIXELS + "SELECT image_id, 8 AS height, 8 AS width, CAST(idx AS INTEGER) AS idx, round(v, 6) AS value FROM px")
def image_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = dt.images(spark, sf_dir).select(
        "image_id", px.ensure_2d(F.col("dims"), F.col("pixels")).alias("image")
    )
    return dt.pixel_rows(images)


@query(
    PIXELS
    + BOX
    + """SELECT image_id, CAST(top AS INTEGER) AS top, CAST(lft AS INTEGER) AS "left",
                CAST(bottom AS INTEGER) AS bottom, CAST(rgt AS INTEGER) AS "right" FROM box"""
)
def foreground_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.images(spark, sf_dir).select("image_id", px.foreground_box(F.col("image")).alias("box")).select(
        "image_id", "box.*"
    )


query(
    PIXELS
    + BOX
    + """SELECT px.image_id, CAST(bottom - top AS INTEGER) AS height, CAST(rgt - lft AS INTEGER) AS width,
                CAST((r - top) * (rgt - lft) + (c - lft) AS INTEGER) AS idx, round(v, 6) AS value
         FROM px JOIN box ON px.image_id = box.image_id
         WHERE r >= top AND r < bottom AND c >= lft AND c < rgt""",
    "crop_foreground",
)(_changed(px.crop_foreground))

query(
    PIXELS
    + """SELECT image_id, 4 AS height, 4 AS width, CAST((r // 2) * 4 + c // 2 AS INTEGER) AS idx,
                round(sum(v) / 4, 6) AS value FROM px GROUP BY image_id, r // 2, c // 2""",
    "resize_area",
)(_changed(lambda i: px.resize_longest(i, 4)))

query(
    """WITH cells AS (SELECT vec_id AS image_id, embedding, k AS idx, k // 6 - 1 AS r, k % 6 + 1 AS c
                      FROM embeddings, generate_series(0, 59) g(k))
       SELECT image_id, 10 AS height, 6 AS width, CAST(idx AS INTEGER) AS idx,
              round(CASE WHEN r BETWEEN 0 AND 7 THEN CAST(embedding[CAST(r * 8 + c + 1 AS INTEGER)] AS DOUBLE)
                         ELSE 0.0 END, 6) AS value FROM cells""",
    "pad_or_crop",
)(_changed(lambda i: px.pad_or_crop(i, 10, 6)))

query(
    PIXELS
    + """SELECT px.image_id, 8 AS height, 8 AS width, CAST(idx AS INTEGER) AS idx,
                round(CASE WHEN hi = lo THEN v * 0.0 ELSE (v - lo) / (hi - lo) * 255.0 + 0.0 END, 6) AS value
         FROM px JOIN ends ON px.image_id = ends.image_id""",
    "scale_intensity",
)(_changed(lambda i: px.scale_intensity(i, 0.0, 255.0)))

query(
    PIXELS
    + """SELECT image_id, 8 AS height, 8 AS width, CAST(idx AS INTEGER) AS idx,
                CAST(floor(least(greatest(v * 1000.0, 0.0), 255.0)) AS DOUBLE) AS value FROM px""",
    "to_uint8",
)(
    _changed(
        lambda i: px.to_uint8(
            px.make_image(
                i.getField("height"), i.getField("width"), F.transform(i.getField("pixels"), lambda v: v * 1000.0)
            )
        )
    )
)

query(
    PIXELS + "SELECT image_id, 8 AS height, 8 AS width, CAST(idx AS INTEGER) AS idx, round(v, 6) AS value FROM px",
    "to_float",
)(_changed(px.to_float))

FLIP = """
, coin AS (SELECT vec_id AS image_id,
                  CAST(('0x' || substr(md5('42:0:' || vec_id), 1, 8)) AS UBIGINT) / 4294967296.0 < 0.5 AS heads
           FROM embeddings)"""


@query(
    PIXELS
    + FLIP
    + """SELECT px.image_id, 8 AS height, 8 AS width,
                CAST(CASE WHEN heads THEN (7 - r) * 8 + c ELSE idx END AS INTEGER) AS idx, round(v, 6) AS value
         FROM px JOIN coin ON px.image_id = coin.image_id"""
)
def random_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = dt.images(spark, sf_dir)
    return dt.pixel_rows(images.withColumn("image", px.random_flip(F.col("image"), F.col("image_id"))))


query(
    """WITH cells AS (SELECT vec_id AS image_id, embedding, k AS idx, k // 10 - 1 AS r, k % 10 - 1 AS c
                      FROM embeddings, generate_series(0, 99) g(k))
       SELECT image_id, 10 AS height, 10 AS width, CAST(idx AS INTEGER) AS idx,
              round(CASE WHEN r BETWEEN 0 AND 7 AND c BETWEEN 0 AND 7
                         THEN CAST(embedding[CAST(r * 8 + c + 1 AS INTEGER)] AS DOUBLE) ELSE 0.0 END, 6) AS value
       FROM cells""",
    "divisible_pad",
)(_changed(lambda i: px.divisible_pad(i, 5)))

# The whole chain in SQL: crop, area resize to longest side 4, pad to 6 x 6, stretch to 0..255,
# whole numbers, optional flip, stretch to 0..1, pad to a multiple of 5 (10 x 10).
CHAIN = (
    PIXELS
    + BOX
    + FLIP
    + """, cropped AS (
  SELECT px.image_id, r - top AS r, c - lft AS c, bottom - top AS bh, rgt - lft AS bw, v
  FROM px JOIN box ON px.image_id = box.image_id WHERE r >= top AND r < bottom AND c >= lft AND c < rgt
), sides AS (
  SELECT DISTINCT image_id, bh, bw, greatest(CAST(round_even(bh * (4.0::DOUBLE / greatest(bh, bw)), 0) AS BIGINT), 1) AS h,
         greatest(CAST(round_even(bw * (4.0::DOUBLE / greatest(bh, bw)), 0) AS BIGINT), 1) AS w FROM cropped
), targets AS (
  SELECT s.*, i, j, (i * bh) // h AS r0, ((i + 1) * bh + h - 1) // h AS r1,
         (j * bw) // w AS c0, ((j + 1) * bw + w - 1) // w AS c1
  FROM sides s, generate_series(0, 3) a(i), generate_series(0, 3) b(j) WHERE i < h AND j < w
), resized AS (
  SELECT t.image_id, h, w, i, j, sum(v) / count(*) AS v
  FROM targets t JOIN cropped x ON x.image_id = t.image_id AND x.r >= r0 AND x.r < r1 AND x.c >= c0 AND x.c < c1
  GROUP BY t.image_id, h, w, i, j
), padded AS (
  SELECT e.image_id, i, j, coalesce((SELECT v FROM resized z WHERE z.image_id = e.image_id
           AND z.i = g.i - (6 - z.h) // 2 AND z.j = k.j - (6 - z.w) // 2), 0.0) AS v
  FROM ends e, generate_series(0, 5) g(i), generate_series(0, 5) k(j)
), stretched AS (
  SELECT p.image_id, i, j, floor(CASE WHEN hi = lo THEN v * 0.0 ELSE (v - lo) / (hi - lo) * 255.0 + 0.0 END) AS v
  FROM padded p JOIN (SELECT image_id, min(v) AS lo, max(v) AS hi FROM padded GROUP BY 1) m ON m.image_id = p.image_id
), flipped AS (
  SELECT s.image_id, CASE WHEN {flip} THEN 5 - i ELSE i END AS i, j, v
  FROM stretched s JOIN coin ON coin.image_id = s.image_id
), final AS (
  SELECT f.image_id, i, j, CASE WHEN hi = lo THEN v * 0.0 ELSE (v - lo) / (hi - lo) * 1.0 + 0.0 END AS v
  FROM flipped f JOIN (SELECT image_id, min(v) AS lo, max(v) AS hi FROM flipped GROUP BY 1) m ON m.image_id = f.image_id
)
SELECT e.image_id AS subject_id, 10 AS height, 10 AS width, CAST(a.i * 10 + b.j AS INTEGER) AS idx,
       round(CAST(CAST(coalesce(f.v, 0.0) AS FLOAT) AS DOUBLE), 6) AS value
FROM ends e, generate_series(0, 9) a(i), generate_series(0, 9) b(j)
LEFT JOIN final f ON f.image_id = e.image_id AND f.i = a.i - 2 AND f.j = b.j - 2"""
)


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dt.images(spark, sf_dir).withColumnRenamed("image_id", "subject_id")


@query(CHAIN.format(flip="false"))
def image_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = im.compose(im.normalise_sized(4, 6), im.finalise(5))
    return dt.pixel_rows(chain(_subjects(spark, sf_dir)), key="subject_id")


@query(CHAIN.format(flip="heads"))
def image_pipeline_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = im.compose(im.normalise_sized(4, 6), im.augment(), im.finalise(5))
    return dt.pixel_rows(chain(_subjects(spark, sf_dir)), key="subject_id")


@query(CHAIN.format(flip="heads"))
def image_pipeline_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = im.prepare_images(_subjects(spark, sf_dir), train=True, size=4, frame=6, k=5)
    return dt.pixel_rows(done, key="subject_id")


# ---- files and series --------------------------------------------------------------------------

FILES = r"""
WITH files AS (
  SELECT regexp_extract(url, '(example[.][a-z]+)', 1) AS object_uri, url AS path,
         regexp_replace(url, '/[^/]*$', '') AS series_dir FROM pages
), series AS (
  SELECT object_uri, series_dir, count(*) AS n_files, min(path) AS first_path FROM files GROUP BY 1, 2
)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as image files; the registered domain is the object."""
    return dt.table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"(example[.][a-z]+)", 1).alias("object_uri"), F.col("url").alias("path")
    )


HOSTS = FILES.replace("regexp_extract(url, '(example[.][a-z]+)', 1)", "regexp_extract(url, '//([^/]+)/', 1)")


def host_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the full host as the object."""
    return dt.table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "//([^/]+)/", 1).alias("object_uri"), F.col("url").alias("path")
    )


@query("SELECT page_id, url FROM pages WHERE url LIKE '%.html'")
def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_files(dt.table(spark, sf_dir, "pages"), ".html", "url").select("page_id", "url")


@query(FILES + "SELECT object_uri, series_dir, n_files, first_path FROM series")
def group_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.group_series(files(spark, sf_dir))


@query(
    HOSTS
    + """SELECT object_uri, CAST(sum(n_files) AS BIGINT) AS n_files, count(*) AS n_series,
                CASE WHEN sum(n_files) = 1 THEN 'single' WHEN count(*) = 1 THEN 'series' ELSE 'several' END AS kind
         FROM series GROUP BY 1
         UNION ALL SELECT 'source:' || source, 0, 0, 'failure' FROM documents GROUP BY source"""
)
def object_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = host_files(spark, sf_dir)
    without_files = dt.table(spark, sf_dir, "documents").select(dt.text("source:", F.col("source")).alias("object_uri"))
    objects = pages.select("object_uri").unionByName(without_files).distinct()
    return ser.object_kinds(objects, ser.group_series(pages))


CHOSEN = """SELECT object_uri, series_dir, n_files, first_path, n_series FROM (
              SELECT *, row_number() OVER (PARTITION BY object_uri ORDER BY series_dir {way}) AS rn,
                     count(*) OVER (PARTITION BY object_uri) AS n_series FROM series) WHERE {which}"""


@query(FILES + CHOSEN.format(way="ASC", which="rn = 1"))
def series_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.choose_series(ser.group_series(files(spark, sf_dir)), ser.KEEP_FIRST)


@query(FILES + CHOSEN.format(way="DESC", which="rn = 1"))
def series_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.choose_series(ser.group_series(files(spark, sf_dir)), ser.KEEP_LAST)


@query(HOSTS + CHOSEN.format(way="ASC", which="n_series = 1"))
def series_single_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.choose_series(ser.group_series(host_files(spark, sf_dir)), ser.ERROR)


@query(
    FILES
    + """SELECT object_uri, count(*) AS n_series, CAST(sum(n_files) AS BIGINT) AS n_files FROM series
         GROUP BY 1 HAVING count(*) > 1"""
)
def series_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ser.series_conflicts(ser.group_series(files(spark, sf_dir)))


@query(
    r"""SELECT doc_id AS subject_id, 'example.' || lang AS action_data,
               'example.' || lang IN (SELECT regexp_extract(url, '(example[.][a-z]+)', 1) FROM pages) AS available
        FROM documents
        UNION ALL
        SELECT page_id, regexp_extract(url, '(example[.][a-z]+)', 1), true FROM pages"""
)
def image_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = dt.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("subject_id"), F.regexp_extract("url", r"(example[.][a-z]+)", 1).alias("action_data")
    )
    asked = dt.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("subject_id"), F.concat(F.lit("example."), "lang").alias("action_data")
    )
    items = known.unionByName(asked).withColumn("data_type", F.lit("xnat_uri"))
    return ser.image_availability(items, files(spark, sf_dir)).select("subject_id", "action_data", "available")


def grey_text(content: bytes) -> tuple[int, int, list[float]]:
    """Decoder of the driver's stand-in format: 64 numbers as text. Longer input is malformed."""
    values = [float(v) for v in content.decode("ascii").split(",")]
    if len(values) != 64:
        raise ValueError(f"{len(values)} values")
    return 8, 8, values


@query(
    """SELECT vec_id AS subject_id, CASE WHEN label = 0 THEN 'no file' WHEN label = 1 THEN 'several series'
              WHEN label = 9 THEN 'ValueError: 65 values' END AS error,
              CASE WHEN label BETWEEN 2 AND 8 THEN round(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]), 6) END AS total,
              '/scans/' || vec_id AS action_data FROM embeddings
       UNION ALL SELECT vec_id, NULL, NULL, label::VARCHAR FROM embeddings"""
)
def load_images_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects without file, with several series and with a broken file, and value items beside them."""
    rows = dt.table(spark, sf_dir, "embeddings").withColumn("uri", dt.text("/scans/", F.col("vec_id")))
    subject = F.col("vec_id").alias("subject_id")
    items = rows.select(subject, F.col("uri").alias("action_data"), F.lit("xnat_uri").alias("data_type")).unionByName(
        rows.select(subject, F.col("label").cast("string").alias("action_data"), F.lit("value").alias("data_type"))
    )
    body = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")
    folders = F.when(F.col("label") == 0, F.array()).when(F.col("label") == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    contents = rows.select("uri", "label", body.alias("body"), F.explode(folders).alias("folder")).select(
        F.col("uri").alias("object_uri"),
        F.concat("uri", F.lit("/"), "folder", F.lit("/1.img")).alias("path"),
        F.encode(F.when(F.col("label") == 9, F.concat("body", F.lit(",0"))).otherwise(F.col("body")), "UTF-8").alias("content"),
    )
    total = F.aggregate("image.pixels", F.lit(0.0), lambda acc, v: acc + v)
    loaded = ser.load_images(items, contents, grey_text)
    return loaded.select("subject_id", "error", F.round(total, 6).alias("total"), "action_data")


@query(
    """SELECT vec_id AS subject_id, label < 9 AS decoded, CASE WHEN label < 9 THEN 8 END AS height,
              CASE WHEN label < 9 THEN round(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]), 6) END AS total
       FROM embeddings"""
)
def load_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dt.table(spark, sf_dir, "embeddings").withColumn("uri", dt.text("/scans/", F.col("vec_id")))
    items = rows.select(
        F.col("vec_id").alias("subject_id"), F.col("uri").alias("action_data"), F.lit("xnat_uri").alias("data_type")
    )
    body = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")
    spoiled = F.when(F.col("label") == 9, F.concat(body, F.lit(",0"))).otherwise(body)
    contents = rows.select(
        F.col("uri").alias("object_uri"),
        F.concat("uri", F.lit("/1.img")).alias("path"),
        F.encode(spoiled, "UTF-8").alias("content"),
    )
    loaded = ser.load_images(items, contents, grey_text)
    total = F.aggregate("image.pixels", F.lit(0.0), lambda acc, v: acc + v)
    return loaded.select(
        "subject_id",
        F.col("error").isNull().alias("decoded"),
        F.col("image.height").alias("height"),
        F.round(total, 6).alias("total"),
    )
