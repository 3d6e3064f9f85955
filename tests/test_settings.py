"""Configuration files: read as given, and refused with a reason."""

import json

import pytest

from logwarden import DetectionSettings, load_settings
from logwarden.settings import BruteForce, Scale

GOOD = {
    "linux_brute_force": {"threshold": 7, "window_seconds": 60},
    "linux_user_enumeration": {"distinct_user_threshold": 3, "window_seconds": 61},
    "successful_login_after_failures": {"failure_threshold": 2, "window_seconds": 62},
    "cisco_interface_flap": {"window_seconds": 63},
    "suspicious_sudo": {"keywords": ["passwd"]},
    "aws": {"public_admin_ports": [22], "privileged_policies": ["Admin"]},
}


def load(tmp_path, raw):
    path = tmp_path / "rules.json"
    path.write_text(raw if isinstance(raw, str) else json.dumps(raw))
    return load_settings(path)


def test_a_file_is_read(tmp_path):
    got = load(tmp_path, {"detection": {**GOOD, "batch_unit": "hour", "scale": {"salts": 3}}})
    assert (got.linux_brute_force, got.scale, got.batch_unit) == (BruteForce(7, 60), Scale(3), "hour")
    assert tuple(got.aws.public_admin_ports) == (22,) and got.cisco_interface_flap.window_seconds == 63
    assert DetectionSettings().linux_brute_force.threshold == 4


@pytest.mark.parametrize(
    ("raw", "reason"),
    [
        ("{", "Expecting"),
        ([], "must be a mapping"),
        ({"detection": GOOD, "more": 1}, "unknown keys"),
        ({"detection": {**GOOD, "more": {}}}, "unknown keys"),
        ({"detection": {k: v for k, v in GOOD.items() if k != "aws"}}, "missing keys"),
        ({"detection": {**GOOD, "linux_brute_force": {"threshold": 0, "window_seconds": 1}}}, "threshold"),
        ({"detection": {**GOOD, "linux_brute_force": {"threshold": 1, "window_seconds": -5}}}, "window_seconds"),
        ({"detection": {**GOOD, "linux_brute_force": {"threshold": 1}}}, "missing keys"),
        ({"detection": {**GOOD, "cisco_interface_flap": 3}}, "must be a mapping"),
        ({"detection": {**GOOD, "suspicious_sudo": {"keywords": "passwd"}}}, "keywords"),
        ({"detection": {**GOOD, "aws": {"public_admin_ports": ["22"], "privileged_policies": []}}}, "public_admin_ports"),
        ({"detection": {**GOOD, "scale": {"salts": 0}}}, "salts"),
    ],
)
def test_a_wrong_file_is_refused(tmp_path, raw, reason):
    with pytest.raises(ValueError, match=f"Invalid detection configuration.*{reason}"):
        load(tmp_path, raw)


def test_a_missing_file_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_settings(tmp_path / "none.json")
