from pyspark.sql import functions as F

from botlens.config import SENSITIVE, Weights
from botlens.functions import agents, requests, scores
from botlens.operators import features, scoring


def column(spark, kind, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


AGENTS = [None, "", "-", "Cubot", "JavaScript", "Googlebot/2.1", "Mozilla/5.0 Firefox", "NMAP"]


def test_suspicious_agents(spark):
    assert column(spark, "string", AGENTS, agents.is_suspicious) == [1, 1, 0, 1, 1, 1, 0, 0]


def test_dash_and_whitelist(spark):
    found = column(
        spark, "string", AGENTS,
        lambda c: agents.is_suspicious(c, whitelist=("googlebot",), dash_is_empty=True),
    )
    assert found == [1, 1, 1, 1, 1, 0, 0, 0]


def test_tools_and_browsers(spark):
    assert column(spark, "string", AGENTS, agents.is_tool) == [0, 0, 0, 1, 0, 1, 0, 1]
    assert column(spark, "string", AGENTS, agents.is_browser) == [0, 0, 0, 0, 0, 0, 1, 0]


def test_regex_words_keep_their_meaning(spark):
    words = ("go.http", "bot$")
    found = column(spark, "string", ["GO-HTTP", "bots", "a bot", None], lambda c: agents.flag(agents.mentions(c, words)))
    assert found == [1, 0, 1, 0]
    assert column(spark, "string", ["x", None], lambda c: agents.flag(agents.mentions(c, ()))) == [0, 0]


STATUS = [None, 199, 200, 299, 304, 399, 400, 499, 500, 599, 600]


def test_status_classes(spark):
    assert column(spark, "int", STATUS, requests.is_failure) == [0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 1]
    assert column(spark, "int", STATUS, requests.is_client_error) == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0]
    assert column(spark, "int", STATUS, requests.is_server_error) == [0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 0]
    assert column(spark, "int", STATUS, requests.is_success) == [0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0]


def test_port_protocol_and_type(make_events):
    rows = features.model_row_features(make_events(
        {"port": None, "path": "https://x", "type": None, "protocol": None},
        {"port": None, "path": None, "type": None, "protocol": "tcp"},
        {"port": 8443, "type": "https", "protocol": "UDP"},
        {"port": 443, "type": "HTTP"},
    )).orderBy("event_id").collect()
    assert [r.Port for r in rows] == [443, 80, 8443, 443]
    assert [r.Request_Type for r in rows] == [1, 0, 1, 0]
    assert [r.Protocol for r in rows] == [0, 0, 1, 0]
    assert [r.is_encrypted for r in rows] == [1, 0, 1, 1]


def test_paths(spark):
    paths = ["/x/wp-admin/y", "/.env", "/", None]
    assert column(spark, "string", paths, requests.is_admin_path) == [1, 0, 0, 0]
    assert column(spark, "string", paths, requests.is_probe_path) == [0, 1, 0, 0]


def test_burst_score(spark):
    found = column(spark, "bigint", [0, 4, 5, 6, 7, 10, 99], lambda c: scores.burst_score(c, 10))
    assert found == [0.0, 0.0, 0.0, 0.2, 0.4, 1.0, 1.0]
    assert column(spark, "bigint", [2, 3], lambda c: scores.burst_score(c, 3)) == [0.5 / 1.5, 1.0]


def test_error_score(spark):
    assert column(spark, "double", [0.0, 0.25, 0.5, 1.0, None], lambda c: scores.error_score(c, 0.5)) == [0.0, 0.5, 1.0, 1.0, 0.0]


def test_reasons_and_legacy_reasons(spark):
    windows = spark.createDataFrame(
        [(10, 1.0, 1.0), (6, 0.25, 0.0)], "request_count bigint, error_ratio double, ua_suspicious_ratio double"
    )
    scored = scoring.rule_scores(windows, SENSITIVE.detection)
    clean = scoring.rule_reasons(scored).orderBy("request_count").collect()
    assert [r.detection_reasons for r in clean] == ["", "high_request_rate, high_error_ratio, suspicious_user_agent"]
    assert [len(r.reasons) for r in clean] == [0, 3]
    legacy = scoring.rule_reasons(scored, legacy=True).orderBy("request_count").first()
    assert legacy.detection_reasons == ", , "


def test_weights_are_used(spark):
    one = spark.range(1).select(
        scores.weighted(F.lit(1.0), F.lit(0.0), F.lit(0.5), Weights(0.2, 0.3, 0.5)).alias("s")
    )
    assert one.first().s == 0.2 + 0.25


def test_rules_run_in_order(make_events):
    rules = features.Rules(features.admin_path_rule)

    @rules.add
    def doubled(events):
        return events.withColumn("twice", F.col("suspicious_pattern") * 2)

    row = make_events({"path": "/admin"}).transform(rules).first()
    assert (row.suspicious_pattern, row.twice) == (1, 2)
