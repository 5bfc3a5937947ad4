import pytest

from conformance.queries import JOBS
from pledgeflow.schema import TABLES, references_to
from pledgeflow.sources.adapters import DriverTables

SF = "/root/testdata"

# Row counts of the derived tables at the two small scales.
COUNTS = {
    "sf0.001": dict(
        employees=10, users=160, backers=150, creators=10, verifies=139, project_types=6, projects=200, updates=1000,
        rewards=585, backs=5382, refunds=957, email_map=24, registrations=150,
        project_loads=200, raw_dates=200,
    ),
    "sf0.01": dict(
        employees=100, users=1600, backers=1490, creators=100, verifies=1378, project_types=6, projects=2000, updates=10000,
        rewards=5910, backs=59391, refunds=10171, email_map=230, registrations=1500,
        project_loads=2000, raw_dates=2000,
    ),
}


def test_references_point_at_columns_of_the_same_type():
    for spec in TABLES.values():
        assert set(spec.key) <= set(spec.required)
        for fk in spec.foreign_keys:
            parent = TABLES[fk.parent]
            for child_column, parent_column in zip(fk.columns, fk.parent_columns):
                assert spec.schema[child_column].dataType == parent.schema[parent_column].dataType
            assert set(fk.parent_columns) == set(parent.key)


def test_references_to_users():
    assert {spec.name for spec, _ in references_to("users")} == {"verifies", "backers", "creators"}


@pytest.mark.parametrize("scale", COUNTS)
def test_derived_tables_have_the_known_size(spark, scale):
    tables = DriverTables(spark, f"{SF}/{scale}")
    assert {name: tables[name].count() for name in COUNTS[scale]} == COUNTS[scale]


def test_derived_tables_have_the_declared_columns(spark):
    tables = DriverTables(spark, f"{SF}/sf0.001")
    for name, spec in TABLES.items():
        assert tables[name].columns == spec.schema.names


@pytest.mark.parametrize("job", [
    "audit_unique", "audit_unique_digest", "ingest_pledges_again", "ingest_policy", "write_back_deletes", "stream_refunds",
])
def test_jobs_that_read_pledges_often_derive_them_once(spark, job, monkeypatch):
    tables = DriverTables(spark, f"{SF}/sf0.001")
    read = []
    source = tables.source
    monkeypatch.setattr(tables, "source", lambda name: read.append(name) or source(name))
    JOBS[job](tables)
    assert read.count("lineitem") == 1
    assert all("lineitem" not in f for n in ("backs", "offered_backs", "refunds") for f in tables[n].inputFiles())
