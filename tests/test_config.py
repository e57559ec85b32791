import pytest

from botlens.config import SENSITIVE, STANDARD, Weights, deep_merge, load_settings


def test_presets():
    assert SENSITIVE.detection.window_duration == "30 seconds"
    assert STANDARD.detection.burst_threshold == 100
    assert STANDARD.user_agent.whitelist == ("googlebot", "bingbot", "slackbot")


def test_merge_keeps_siblings():
    assert deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_yaml_settings(tmp_path):
    path = tmp_path / "settings.yaml"
    path.write_text(
        "detection:\n  burst_threshold: 20\n  weights: {burst: 0.5, error: 0.25, user_agent: 0.25}\n"
        "user_agent:\n  bot_patterns: [bot]\n"
        "spark:\n  checkpoint_location: /data/cp\n  streaming:\n    trigger_interval: 10 seconds\n"
        "unknown: 1\n"
    )
    found = load_settings(str(path))
    assert found.detection.burst_threshold == 20
    assert found.detection.weights == Weights(0.5, 0.25, 0.25)
    assert found.detection.error_ratio_threshold == 0.5
    assert found.user_agent.bot_patterns == ("bot",)
    assert found.checkpoint.location == "/data/cp"
    assert found.streaming.trigger_interval == "10 seconds"


def test_no_file_is_the_preset():
    assert load_settings(None, STANDARD) is STANDARD


def test_bad_weights_and_thresholds():
    with pytest.raises(ValueError):
        Weights(0.5, 0.5, 0.5)
    with pytest.raises(ValueError):
        SENSITIVE.override({"detection": {"burst_threshold": 0}})


def test_unknown_settings_are_errors():
    with pytest.raises(ValueError, match="burst_treshold"):
        SENSITIVE.override({"detection": {"burst_treshold": 3}})
    assert SENSITIVE.override({"elasticsearch": {"host": "x"}}) == SENSITIVE
    assert STANDARD.streaming.max_offsets_per_trigger is None
