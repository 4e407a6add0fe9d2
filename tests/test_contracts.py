from __future__ import annotations

import json

import pytest

from sightline.operators import contracts
from sightline.operators.decode import decodable

DATES = {
    "2026-05-16T15:10:00Z": True, "2026-05-16t15:10:00.25z": True, "2026-05-16T15:10:00+02:00": True, "2024-02-29T23:59:60Z": True,
    "2026-05-16": False, "2026-05-16T15:10:00": False, "2026-W20-6": False, "2023-02-29T00:00:00Z": False, "2026-05-16T24:00:00Z": False,
    "2026-05-16 15:10:00Z": False, "2026-05-16T15:10:00+24:00": False, "": False, "x2026-05-16T15:10:00Z": False,
}


@pytest.mark.parametrize("field", ["updated_at"])
def test_date_times_are_rfc_3339(spark, field):
    good = {"user_id": "u", "species_code": "s", "priority": "low", "radius_km": 1, "active": True}
    rows = [(json.dumps(good | {field: text}).encode(),) for text in DATES]
    log = spark.createDataFrame(rows, "value binary")
    decoded = decodable(log, contracts.fields_of(contracts.PREFERENCE_CONTRACT))
    found = contracts.contract_violations(decoded, contracts.PREFERENCE_CONTRACT).collect()
    assert {json.loads(r.text)[field]: not r.violations for r in found} == DATES


def test_absent_null_and_mistyped_fields_differ(spark):
    rows = [(b'{"user_id":null,"species_code":7,"priority":"urgent","radius_km":"5","active":1}',)]
    decoded = decodable(spark.createDataFrame(rows, "value binary"), contracts.fields_of(contracts.PREFERENCE_CONTRACT))
    found = contracts.contract_violations(decoded, contracts.PREFERENCE_CONTRACT).first()
    assert found.violations == [
        "user_id: type", "species_code: type", "priority: enum", "radius_km: type", "active: type", "updated_at: required",
    ]
