"""bench.py helpers: the event-log summary."""

import json

import bench


def test_event_log_summary(tmp_path):
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1],
         "Properties": {"spark.jobGroup.id": "q1"}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 2 * 1024 * 1024},
            "Input Metrics": {"Bytes Read": 1024 * 1024}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task Metrics": {
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 0},
            "Input Metrics": {"Bytes Read": 0}}},
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Stage IDs": [2], "Properties": {}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 2, "Task Metrics": {}},
    ]
    (tmp_path / "app").mkdir()
    (tmp_path / "app" / "events").write_text("\n".join(json.dumps(e) for e in events))
    got = bench.event_log_summary(str(tmp_path), runs=2)
    assert got == {"q1": {"shuffle_mb": 1.0, "input_mb": 0.5, "stages": 1.0}}
