import pytest
from pyspark.sql import functions as F

from pairgrid.functions import gates

QUALITY = (
    "target_actor_pixels LONG, complete_projected_asset_pixels LONG, silhouette_iou DOUBLE, center_error_px DOUBLE, width_ratio DOUBLE, "
    "height_ratio DOUBLE, bottom_error_px DOUBLE, orientation_error_deg DOUBLE, ground_lock_pass BOOLEAN, "
    "catastrophic_asset_safety_pass BOOLEAN, broken_or_doubled_asset BOOLEAN, verified_foreground_occlusion_applied BOOLEAN, "
    "degenerate_rectangle_mask BOOLEAN, renderer_quality_gate_pass BOOLEAN, renderer_geometry_gate_pass BOOLEAN"
)
SOUND = dict(
    target_actor_pixels=1680, complete_projected_asset_pixels=1680, silhouette_iou=0.8, center_error_px=1.0, width_ratio=1.0,
    height_ratio=1.0, bottom_error_px=1.0, orientation_error_deg=2.0, ground_lock_pass=True, catastrophic_asset_safety_pass=True,
    broken_or_doubled_asset=False,
)
STRICT = dict(height_ratio=0.76, renderer_quality_gate_pass=True, renderer_geometry_gate_pass=True)


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, True),
        ({"orientation_error_deg": 170.0}, False),
        ({"orientation_error_deg": None}, True),
        ({"orientation_error_deg": -80.0}, True),
        ({"orientation_error_deg": 23.0}, False),
        ({"silhouette_iou": float("nan")}, False),
        ({"silhouette_iou": None}, False),
        ({"bottom_error_px": 11.0}, False),
        ({"bottom_error_px": 11.0, "verified_foreground_occlusion_applied": True}, True),
        ({"broken_or_doubled_asset": None}, True),
        ({"ground_lock_pass": None}, False),
        (STRICT, True),
        (STRICT | {"orientation_error_deg": 170.0}, False),
        (STRICT | {"renderer_geometry_gate_pass": False}, False),
    ],
)
def test_geometry_gate(spark, change, expected):
    names = [p.split()[0] for p in QUALITY.split(", ")]
    values = SOUND | change
    df = spark.createDataFrame([tuple(values.get(n) for n in names)], QUALITY)
    assert df.select(gates.geometry_pass(F.struct(*names))).first()[0] is expected


def test_materiality_boundaries(spark):
    df = spark.createDataFrame([(15, 400), (16, 400), (17, 425), (16, 425)], "pixels LONG, support LONG")
    got = [r[0] for r in df.select(gates.kept_occlusion(F.col("pixels"), F.col("support"))).collect()]
    assert got == [0, 16, 17, 0]


def test_without_a_complete_count_the_visible_part_is_the_whole(spark):
    df = spark.createDataFrame([(20, None), (20, 0), (20, 133), (20, 134), (19, 19)], "v LONG, c LONG")
    got = [r[0] for r in df.select(gates.visible_enough(F.col("v"), F.col("c"))).collect()]
    assert got == [True, True, True, False, False]
