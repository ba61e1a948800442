"""Tables derived from ``lineitem`` and ``embeddings``, for queries and tests.

Each function has a DuckDB twin of the same name in ``fixture_sql``. Everything
comes from keys and small integers, so both engines agree and the density per
scene is the same at every scale. All rows of the source tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairgrid.functions.semantics import ROLES, frame_name, padded, window_name

CATEGORIES = ("car", "truck", "bus", "van")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _numbered(prefix: str, n: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), padded(n, width))


def _obj_id(n: Column) -> Column:
    return _numbered("obj-", n, 6)


def _alias_id(n: Column) -> Column:
    return _numbered("uid-", n, 6)


def _instance(n: Column) -> Column:
    return _numbered("inst-", F.floor(n / 2), 6)


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Observations as integers: one row per (scene, frame, camera, object).

    Rows are dealt by scene, the only time that lines move: whatever is grouped or joined
    within a scene afterwards stays where it is.
    """
    scene_no = F.expr("l_orderkey div 60")
    return (
        _table(spark, sf, "lineitem")
        .select(
            _numbered("scene-", scene_no, 5).alias("scene_name"),
            F.expr("cast((l_orderkey % 60) div 6 as int)").alias("frame_index"),
            ((F.col("l_linenumber") - 1) % 6).alias("cam"),
            (scene_no * 6 + F.col("l_suppkey") % 6).alias("obj_no"),
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").cast("int").alias("q"),
            F.round(F.col("l_discount") * 100).cast("int").alias("d"),
            F.round(F.col("l_tax") * 100).cast("int").alias("t"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("r"),
        )
        .repartition("scene_name")
        .groupBy("scene_name", "frame_index", "cam", "obj_no")
        .agg(
            F.min("l_partkey").alias("pk"),
            F.max("l_suppkey").alias("sk"),
            F.count(F.lit(1)).alias("n"),
            F.max("q").alias("q"),
            F.max("d").alias("d"),
            F.max("t").alias("t"),
            F.max("r").alias("r"),
        )
    )


def obs(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (scene, frame, camera, object)."""
    return _cells(spark, sf).select(
        "scene_name",
        window_name(F.expr("frame_index div 5 * 5")).alias("window_id"),
        "frame_index",
        F.col("cam").cast("string").alias("camera_id"),
        _obj_id(F.col("obj_no")).alias("obj_id"),
        _instance(F.col("obj_no")).alias("instance_token"),
        (F.col("q") * 6).alias("area_pixels"),
        (1 + F.col("sk") % 4).cast("int").alias("visibility_level"),
        (F.col("q") >= 25).alias("usable"),
        "obj_no", "pk", "sk", "n", "q", "d", "t", "r",
    )


def category(obj_no: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (obj_no % 4 + 1).cast("int"))


def assets(spark: SparkSession, sf: str) -> DataFrame:
    """Known assets: objects seen large at least once."""
    n = F.col("obj_no")
    return (
        obs(spark, sf)
        .groupBy("obj_no")
        .agg(F.max("q").alias("q"), F.min("q").alias("least"))
        .filter(F.col("q") >= 46)
        .select(
            _numbered("a", n, 11).alias("asset_id"),
            _obj_id(n).alias("obj_id"),
            _instance(F.col("obj_no")).alias("instance_token"),
            category(n).alias("category"),
            F.concat(_numbered("assets/", n, 6), F.lit(".ply")).alias("ply_path"),
            F.sha2(F.concat(F.lit("ply|"), n), 256).alias("ply_sha256"),
            F.array((40 + n % 5) / 10.0, (18 + n % 3) / 10.0, (15 + n % 4) / 10.0).alias("dimensions_m"),
            F.lit("+X").alias("forward_axis"),
            n.alias("obj_no"),
            "least",
        )
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (scene, window, frame, object) with its list of cameras."""
    return (
        obs(spark, sf)
        .groupBy("scene_name", "window_id", "frame_index", "obj_id", "instance_token", "obj_no")
        .agg(
            F.max("area_pixels").alias("area_pixels"),
            F.max("visibility_level").alias("visibility_level"),
            F.collect_list(F.concat(F.lit("c"), F.col("camera_id"))).alias("visible_cameras"),
        )
        .withColumn("review_images", F.create_map(F.lit("source"), F.concat(F.lit("img/"), "obj_id")))
    )


def visibility_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (scene, object) with a map from view key to usable."""
    key = F.concat(padded(F.col("frame_index"), 6), F.lit(":c"), "camera_id")
    return (
        obs(spark, sf)
        .groupBy("scene_name", "obj_id", "instance_token", "obj_no")
        .agg(F.map_from_entries(F.collect_list(F.struct(key, "usable"))).alias("target_usable_by_frame_camera"))
        .select(
            "scene_name",
            "obj_id",
            F.lit(None).cast("string").alias("global_uid"),
            F.lit(None).cast("string").alias("instance_token"),
            category(F.col("obj_no")).alias("category"),
            F.struct(
                _alias_id(F.col("obj_no")).alias("global_uid"),
                F.col("obj_id"),
                F.lit(None).cast("string").alias("instance_token"),
                category(F.col("obj_no")).alias("category"),
            ).alias("exact_asset_binding"),
            "target_usable_by_frame_camera",
        )
    )


def _hashed(prefix: str, *cs: Column | str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(prefix), *cs), 256)


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted records: single, pair, and re-rendered (``__b``) ones.

    ``assets`` names an object by its own id or by another alias. A view shows
    at most six objects, so its members fit one row and its pairs (of different
    instances) arise without a join.
    """
    views = _cells(spark, sf).groupBy("scene_name", "frame_index", "cam").agg(
        F.sort_array(F.collect_list(F.struct("obj_no", "pk", "sk", "n", "q", "d", "t", "r"))).alias("m")
    )
    where = [F.col("scene_name"), F.col("frame_index"), F.col("cam").cast("string")]
    # What all records of a view share is computed once for it.
    views = views.withColumns({"gt0": _hashed("gt", *where, F.lit("0")), "gt1": _hashed("gt", *where, F.lit("1")), "target": _hashed("tg", *where)})
    kinds = F.expr(
        """flatten(array(
             transform(filter(m, a -> a.t < 8), a -> named_struct('kind', 1, 'a', a, 'b', a)),
             transform(filter(m, a -> a.t < 8 and a.n > 1 and a.d = 10), a -> named_struct('kind', 2, 'a', a, 'b', a)),
             flatten(transform(m, a -> transform(
               filter(m, b -> a.obj_no div 2 < b.obj_no div 2 and a.t + b.t <= 12),
               b -> named_struct('kind', 3, 'a', a, 'b', b))))))"""
    )

    def named(side: str) -> Column:
        n = F.col(f"{side}.obj_no")
        return F.when(F.col(f"{side}.r") == 1, _obj_id(n)).otherwise(_alias_id(n))

    rows = views.select("scene_name", "frame_index", "cam", "gt0", "gt1", "target", F.explode(kinds).alias("k")).select(
        "scene_name", "frame_index", F.col("cam").cast("string").alias("camera_id"), "gt0", "gt1", "target", "k.kind", "k.a", "k.b"
    )
    pair = F.col("kind") == 3
    first, second = _obj_id(F.col("a.obj_no")), _obj_id(F.col("b.obj_no"))
    both = F.array(first, second)
    where = [F.col("scene_name"), F.col("frame_index"), F.col("camera_id")]
    variant = ~pair & (F.col("a.d") == 10) & (F.col("a.q") > 40)
    listed = F.concat(F.lit('["'), first, F.lit('","'), second, F.lit('"]'))
    plain_input = F.when(pair, _hashed("in", *where, first, second)).otherwise(_hashed("in", *where, first))
    return rows.select(
        F.concat_ws(
            "__",
            "scene_name",
            frame_name(F.col("frame_index")),
            F.when(pair, F.concat(F.lit("cmb-"), F.substring(F.sha2(listed, 256), 1, 12))).otherwise(first),
            F.concat(F.lit("c"), "camera_id"),
            F.when(F.col("kind") == 2, F.lit("b")),
        ).alias("sample_id"),
        "scene_name", "frame_index", "camera_id",
        F.when(pair, F.array(named("a"), named("b"))).otherwise(F.array(named("a"))).alias("assets"),
        F.when(pair, both).otherwise(F.array(first)).alias("selected"),
        F.when(variant, F.col("gt1")).otherwise(F.col("gt0")).alias("gt"),
        F.when(F.col("kind") == 2, F.sha2(F.concat(plain_input, F.lit("b")), 256)).otherwise(plain_input).alias("input"),
        "target",
        "a.pk", "a.sk", "a.n", "a.q", "a.d", "a.t",
    ).withColumn("content_sha256", F.struct("gt", "input", "target"))


def layers(spark: SparkSession, sf: str) -> DataFrame:
    """One rendered layer per observation with its quality numbers."""
    pk, sk = F.col("pk"), F.col("sk")
    quality = F.struct(
        (pk % 2000).alias("target_actor_pixels"),
        (sk * 7).alias("complete_projected_asset_pixels"),
        F.when(pk % 103 == 0, F.lit(float("nan"))).otherwise((pk % 101) / 100.0).alias("silhouette_iou"),
        ((sk % 50) / 4.0).alias("center_error_px"),
        ((60 + pk % 83) / 100.0).alias("width_ratio"),
        ((60 + pk % 89) / 100.0).alias("height_ratio"),
        ((pk % 53) / 4.0).alias("bottom_error_px"),
        F.when(pk % 11 != 0, (sk % 10 * 20 - 60).cast("double")).alias("orientation_error_deg"),
        (pk % 7 != 0).alias("ground_lock_pass"),
        (pk % 13 != 0).alias("catastrophic_asset_safety_pass"),
        F.when(pk % 3 != 0, pk % 17 == 0).alias("broken_or_doubled_asset"),
        (pk % 19 == 0).alias("verified_foreground_occlusion_applied"),
        (pk % 43 == 0).alias("degenerate_rectangle_mask"),
        (pk % 2 == 0).alias("renderer_quality_gate_pass"),
        (sk % 2 == 0).alias("renderer_geometry_gate_pass"),
    )
    return obs(spark, sf).select(
        F.concat_ws("__", "scene_name", frame_name(F.col("frame_index")), F.concat(F.lit("c"), "camera_id")).alias(
            "sample_id"
        ),
        "scene_name", "frame_index", "camera_id", "obj_id", "obj_no", "pk", "sk", "q", "d", "t",
        F.when(F.col("q") > 2, F.col("instance_token")).alias("instance_token"),
        F.when(F.col("d") > 0, F.sha2("obj_id", 256)).otherwise(F.lit("short")).alias("asset_sha256"),
        F.when(F.col("t") > 0, F.lit("+X")).otherwise(F.lit("+Y")).alias("forward_axis"),
        F.array((40 + pk % 5) / 10.0, (18 + pk % 3) / 10.0, F.when(pk % 71 == 0, F.lit(0.0)).otherwise(F.lit(1.5))).alias(
            "official_dimensions_m"
        ),
        (F.col("q") != 7).alias("exact_identity_verified"),
        (F.col("q") != 8).alias("official_dimensions_applied"),
        (F.col("q") != 9).alias("canonical_orientation_applied"),
        F.when(F.col("q") != 10, F.lit(True)).alias("bottom_ground_locked"),
        ((pk % 60) / 2.0).alias("median_depth_m"),
        quality.alias("quality"),
    )


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """One review decision per object."""
    m = F.col("obj_no")
    return (
        obs(spark, sf)
        .groupBy("obj_no")
        .agg(F.min("q").alias("least"))
        .select(
            _numbered("a", m, 11).alias("sample_id"),
            F.sha2(F.concat(F.lit("rq|"), m), 256).alias("request_sha256"),
            F.struct(
                F.when(m % 11 == 0, F.lit("reject")).otherwise(F.lit("accept")).alias("decision"),
                (m % 9 != 0).alias("same_identity"),
                F.when(m % 2 == 0, m % 23 == 0).alias("broken_or_doubled_asset"),
                F.lit(True).alias("orientation_valid"),
                F.when(m % 37 != 0, F.lit(True)).alias("scale_valid"),
                F.lit(True).alias("grounding_valid"),
                (m % 41 == 0).alias("severe_occlusion_error"),
                F.lit(0.5).alias("confidence"),
                F.lit("").alias("reason"),
            ).alias("decision"),
            F.when(m % 31 == 0, F.lit("timeout")).alias("request_error"),
            m.alias("obj_no"),
            "least",
        )
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    """Files found in storage: some lost, some altered, one stray per scene."""
    r = records(spark, sf)
    kept = r.filter((F.col("d") > 0) | (F.col("q") > 10)).select(
        F.explode(
            F.array(*[F.struct(F.lit(x).alias("role"), F.col(x).alias("sha256")) for x in ROLES])
        ).alias("f"),
        F.concat("sample_id", F.lit(".png")).alias("name"),
        "q", "t",
    ).select(
        F.col("f.role"),
        "name",
        F.when((F.col("t") == 0) & (F.col("q") <= 10), F.sha2(F.concat("f.sha256", F.lit("x")), 256))
        .otherwise(F.col("f.sha256")).alias("sha256"),
    )
    stray = r.select("scene_name").distinct().select(
        F.lit("gt").alias("role"),
        F.concat("scene_name", F.lit("__stray.png")).alias("name"),
        F.sha2("scene_name", 256).alias("sha256"),
    )
    return kept.unionByName(stray)


def batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping batches, plus copies of some rows under new ids."""
    r = records(spark, sf).select("sample_id", "camera_id", "gt", "input", "target", "q", "d")
    first = r.filter(F.col("camera_id") <= "3").withColumn("batch", F.lit(0))
    second = r.filter(F.col("camera_id") >= "2").withColumn("batch", F.lit(1))
    copies = r.filter(F.col("q") == 50).withColumns(
        {"sample_id": F.concat("sample_id", F.lit("__copy")), "batch": F.lit(2)}
    )
    return first.unionByName(second).unionByName(copies).select("batch", "sample_id", "gt", "input", "target", "d", "q")


def tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Embedding vectors as 8 x 8 layer tiles, three layers to a sample.

    Equal ids are merged before the vectors are opened.
    """
    e = F.col("e").cast("double")
    return (
        _table(spark, sf, "embeddings")
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .select(
            F.expr("vec_id div 3").alias("sample_no"),
            (F.col("vec_id") % 3).cast("int").alias("ord"),
            (F.col("vec_id") * 7 % 5).cast("double").alias("depth"),
            F.posexplode("embedding").alias("i", "e"),
        )
        .select(
            _numbered("tile-", F.col("sample_no"), 6).alias("sample_id"),
            "ord",
            "depth",
            F.expr("i div 8").cast("int").alias("y"),
            (F.col("i") % 8).alias("x"),
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), e * 2)).alias("alpha"),
            e.alias("e"),
        )
        .withColumn("rgb", F.col("alpha") * (F.col("ord") + 1) / 4)
    )


BACKGROUND = 0.5
