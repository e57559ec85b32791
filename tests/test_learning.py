import numpy as np
import pytest
from pyspark.sql import functions as F

from botlens import values
from botlens.config import SENSITIVE
from botlens.lineage import checkpointed
from botlens.operators import learning
from botlens.operators.detections import with_detection_id
from botlens.plans import catalog, detectors
from conftest import DATA


@pytest.fixture(scope="module")
def training(dense):
    return checkpointed(detectors.training_rows(detectors.fallback_detections(dense, SENSITIVE)))


@pytest.fixture(scope="module")
def model(training):
    return learning.train_forest(training, trees=5, depth=4)


def test_assembling_fills_missing_columns_and_nulls(spark):
    row = learning.assemble_features(spark.sql("select cast(null as int) as Port, 1 as Protocol")).first()
    assert (row.Port, row.Protocol, row.inter_arrival_std) == (0.0, 1.0, 0.0)
    assert all(isinstance(row[n], float) for n in values.FEATURE_NAMES)


def test_weights_balance_the_classes(training):
    sums = training.groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert len(sums) == 2 and sums[0].w == pytest.approx(sums[1].w)


def test_scaling(training):
    scaled = learning.scale_features(training)
    mean, deviation = scaled.agg(F.avg("Payload_Size"), F.stddev("Payload_Size")).first()
    assert mean == pytest.approx(0, abs=1e-9) and deviation == pytest.approx(1)
    assert scaled.agg(F.max("inter_arrival_std")).first()[0] == 0.0  # constant column


def test_oversampling(training):
    rows = with_detection_id(training)
    repeated = learning.oversample(rows, F.col("detection_id"))
    counts = {r.label: r["count"] for r in repeated.groupBy("label").count().collect()}
    before = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert max(before.values()) == max(counts.values())
    assert abs(counts[0] - counts[1]) < 0.15 * max(counts.values())
    assert repeated.select("detection_id", "copy").distinct().count() == repeated.count()


def test_every_minority_row_makes_its_copies(training):
    rows = with_detection_id(training)
    bots = rows.where("label = 1")
    for copies in (1, 2, 5):
        made = learning.interpolate_minority(rows, "detection_id", copies=copies)
        assert made.count() == copies * bots.count()
        assert made.select("detection_id").distinct().count() == made.count()
    made = learning.interpolate_minority(rows, "detection_id", copies=3)
    for pieces in (1, 7, 1000):
        again = learning.interpolate_minority(rows.repartition(5), "detection_id", copies=3, pieces=pieces)
        assert made.exceptAll(again).count() == again.exceptAll(made).count() == 0
    for name in ("requests_per_ip", "avg_payload_per_ip"):
        low, high = bots.agg(F.min(name), F.max(name)).first()
        assert made.where(~F.col(name).between(low, high)).count() == 0
    assert made.where(~F.col("ua_is_tool").isin(0.0, 1.0)).count() == 0
    alone = learning.interpolate_minority(bots.orderBy("detection_id").limit(1), "detection_id", copies=2)
    assert alone.count() == 2 and alone.select("requests_per_ip").distinct().count() == 1


def test_forest_learns_the_labels(training, model):
    judged = learning.predict_threshold(learning.predict_probability(training, model), 0.5)
    right = judged.where(F.col("is_bot") == F.col("label")).count()
    assert right / judged.count() > 0.9
    assert {r[0] for r in judged.select("prediction_method").distinct().collect()} == {"ml_model"}


def test_saved_model_or_fallback(spark, dense, model, tmp_path):
    path = str(tmp_path / "model")
    assert detectors.load_model(spark, None) is None
    assert detectors.load_model(spark, path) is None
    model.save(path)
    loaded = detectors.load_model(spark, path)
    by_model = detectors.model_detections(dense, SENSITIVE, loaded)
    by_rules = detectors.model_detections(dense, SENSITIVE, None)
    assert by_model.count() == by_rules.count()
    assert by_model.first().prediction_method == "ml_model"
    assert by_rules.first().prediction_method == "rule_based"
    same = [f for f in by_rules.schema if f.name not in ("is_bot", "prediction_method")]
    assert all(by_model.schema[f.name].dataType == f.dataType for f in same)


def test_broken_model_raises(spark, tmp_path):
    (tmp_path / "junk").mkdir()
    with pytest.raises(Exception):
        detectors.load_model(spark, str(tmp_path / "junk"))


@pytest.mark.parametrize("given, mode, want", [
    ([0.0, 1.0], "auto", [0.0, 1.0]),
    ([0.0, 2.0], "auto", [0.5, 1 / (1 + np.exp(-2.0))]),
    ([0.0, 1.0], "always", [0.5, 1 / (1 + np.exp(-1.0))]),
    ([0.0, 2.0], "never", [0.0, 2.0]),
])
def test_sigmoid_only_where_needed(spark, given, mode, want):
    frame = spark.createDataFrame([(g,) for g in given], "bot_probability double")
    found = learning.sigmoid_normalize(frame, when=mode)
    assert [r[0] for r in found.orderBy("bot_probability").collect()] == pytest.approx(want)


def test_foreign_model(training):
    def halves(rows):
        assert rows.shape[1] == 16
        return np.full(len(rows), 0.5)

    scored = learning.apply_foreign_model(training, halves)
    assert scored.count() == training.count()
    assert scored.agg(F.avg("bot_probability")).first()[0] == 0.5


def test_python_models_and_scaling(spark, training):
    class WithProbabilities:
        def predict_proba(self, rows):
            hit = (rows[:, 4] >= 10).astype("float64")
            return np.column_stack([1 - hit, hit])

    class Plain:
        def predict(self, rows):
            return (rows[:, 4] >= 10).astype("int64")

    want = training.where("requests_per_ip >= 10").count()
    for model in (WithProbabilities(), Plain()):
        scored = learning.apply_foreign_model(training, learning.python_model(spark, model))
        assert scored.agg(F.sum("bot_probability")).first()[0] == want

    mean, deviation = training.agg(F.avg("Payload_Size"), F.stddev("Payload_Size")).first()
    payload = learning.with_scaling(lambda rows: rows[:, 3], [mean, 0, 0, 0, 0], [deviation, 1, 1, 1, 1])
    scaled = learning.apply_foreign_model(training, payload)
    assert scaled.agg(F.avg("bot_probability")).first()[0] == pytest.approx(0, abs=1e-9)


def field(number, kind, body):
    """One protobuf field: kind 0 is a number, kind 2 is bytes."""
    def number_bytes(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    head = number_bytes(number << 3 | kind)
    return head + (number_bytes(body) if kind == 0 else number_bytes(len(body)) + body)


def onnx_file(path, weights):
    """A model file for sigmoid(x @ weights), written field by field."""
    def value_info(name, width):
        dims = field(1, 2, field(2, 2, b"n")) + field(1, 2, field(1, 0, width))
        tensor = field(1, 0, 1) + field(2, 2, dims)
        return field(1, 2, name) + field(2, 2, field(1, 2, tensor))

    matrix = np.asarray(weights, dtype="<f4").reshape(16, 1)
    constant = field(1, 0, 16) + field(1, 0, 1) + field(2, 0, 1) + field(8, 2, b"w") + field(9, 2, matrix.tobytes())
    product = field(1, 2, b"x") + field(1, 2, b"w") + field(2, 2, b"z") + field(4, 2, b"MatMul")
    squash = field(1, 2, b"z") + field(2, 2, b"p") + field(4, 2, b"Sigmoid")
    graph = (
        field(1, 2, product) + field(1, 2, squash) + field(2, 2, b"g") + field(5, 2, constant)
        + field(11, 2, value_info(b"x", 16)) + field(12, 2, value_info(b"p", 1))
    )
    path.write_bytes(field(1, 0, 8) + field(7, 2, graph) + field(8, 2, field(2, 0, 13)))


def test_onnx_model(training, tmp_path):
    pytest.importorskip("onnxruntime")
    weights = {"requests_per_ip": 0.5, "ua_is_tool": -1.0}
    onnx_file(tmp_path / "m.onnx", [weights.get(n, 0.0) for n in values.FEATURE_NAMES])
    rows = training.select("client_ip", *values.FEATURE_NAMES)
    mine = learning.apply_foreign_model(rows, learning.onnx_model(str(tmp_path / "m.onnx")))
    want = learning.apply_foreign_model(rows, learning.logistic_model(weights, 0.0))
    found, wanted = (
        [r[0] for r in f.orderBy(*rows.columns).select("bot_probability").collect()] for f in (mine, want)
    )
    assert found == pytest.approx(wanted, abs=1e-5)


def test_windows_are_made_once_for_labels_weights_and_scores(spark, monkeypatch):
    read = []
    weigh = detectors.learning.class_weights
    monkeypatch.setattr(detectors.learning, "class_weights", lambda rows: read.append(rows.inputFiles()) or weigh(rows))
    found = catalog.predict_proba(spark, DATA)
    assert len(read) == 1 and not any("events.parquet" in f for f in [*read[0], *found.inputFiles()])


def test_training_input_is_freed_after_fitting(training):
    before = training.sparkSession.sparkContext._jsc.getPersistentRDDs().size()
    learning.train_forest(training, trees=2, depth=2)
    assert training.sparkSession.sparkContext._jsc.getPersistentRDDs().size() == before
