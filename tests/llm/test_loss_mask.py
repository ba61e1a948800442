"""The text under the loss mask is what the spans cut out of the formatted text."""

from pyspark.sql import functions as F

from pairgrid.llm.chat import format_conversations, loss_text

ROWS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "</s>[INST] ok [/INST] \U0001f600"),
    (1, 2, "other>>role", "x"), (1, 3, "assistant", ""), (1, 4, "assistant", "two\\</s>"), (2, 0, "user", "none"), (3, None, "assistant", None),
]


def test_spans_decide_the_loss_text(spark):
    done = format_conversations(spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string"))
    own = loss_text(F.col("formatted"), F.col("loss_spans"))
    moved = F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["length"].alias("length")))
    got = {r.conv_id: r for r in done.select("conv_id", "round_trip", own.alias("own"), loss_text(F.col("formatted"), moved).alias("moved")).collect()}
    assert {k: r.own for k, r in got.items()} == {1: "".join(t for _, _, role, t in ROWS[:5] if role == "assistant"), 2: "", 3: ""}
    assert all(r.round_trip for r in got.values())
    assert got[1].moved != got[1].own
