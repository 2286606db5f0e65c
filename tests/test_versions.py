"""Latest versions and snapshot merges."""

import os

from hypothesis import HealthCheck, given, settings, strategies as st

from clicklake.operators.versions import latest_per_key, merged_snapshot
from clicklake.plans.product_merge import current_version, manifest, read_snapshot, run_product_merge
from clicklake.schemas import CATALOGUE_PRODUCT
from conftest import rows_of

# The sample catalogue and its change records.
CATALOGUE = [
    (1, "product1", "shoes", "lcw", "blue", 100.0, 1611141595000),
    (2, "product2", "shoes", "adidas", "white", 250.0, 1611141595000),
    (3, "product3", "Mobile Phone", "lcw", "black", 10.0, 1611141595000),
    (4, "product4", "hat", "defacto", "blue", 35.0, 1611141595000),
    (5, "product5", "hat", "defacto", "green", 33.0, 1611141595000),
    (6, "product6", "hat", "lcw", "blue", 55.0, 1611141595000),
    (7, "product7", "Laptop", "dell", "white", 4500.0, 1611141595000),
    (8, "product8", "Laptop", "apple", "white", 5500.0, 1611141595000),
    (9, "product9", "Laptop", "apple", "black", 5000.0, 1611141595000),
    (10, "product10", "Mobile Phone", "apple", "white", 1000.0, 1611141595000),
]
CHANGES = [
    (8, "product8_1", "Laptop", "apple", "white", 5700.0, 1611227995000),
    (4, "product4_newName", "hat", "defacto", "blue", 35.0, 1611227995000),
    (2, "product2", "shoes", "adidas", "bone white", 250.0, 1611227995000),
    (2, "product2_newName", "shoes", "adidas", "bone white", 250.0, 1611242395000),
    (12, "product12", "shoes", "nike", "bone white", 200.0, 1611262396000),
]
MERGED = sorted(
    [row for row in CATALOGUE if row[0] not in (2, 4, 8)] + [CHANGES[0], CHANGES[1], CHANGES[3], CHANGES[4]], key=repr
)


def table(spark, rows):
    return spark.createDataFrame(rows, CATALOGUE_PRODUCT)


def test_merge(spark):
    merged = merged_snapshot(table(spark, CATALOGUE), table(spark, CHANGES), "id", "timestamp")
    assert merged.columns == CATALOGUE_PRODUCT.names
    assert rows_of(merged) == MERGED


def test_replay_changes_nothing(spark):
    merged = merged_snapshot(table(spark, MERGED), table(spark, CHANGES), "id", "timestamp")
    assert rows_of(merged) == MERGED


def test_late_equal_and_no_changes(spark):
    snapshot = [CATALOGUE[0]]
    late = [(1, "late", None, None, None, 1.0, 1611141594999)]
    equal = [(1, "equal", None, None, None, 1.0, 1611141595000)]
    assert rows_of(merged_snapshot(table(spark, snapshot), table(spark, late), "id", "timestamp")) == snapshot
    assert rows_of(merged_snapshot(table(spark, snapshot), table(spark, equal), "id", "timestamp")) == equal
    assert rows_of(merged_snapshot(table(spark, snapshot), table(spark, []), "id", "timestamp")) == snapshot


def test_missing_versions_and_ids(spark):
    snapshot = [(1, "a", None, None, None, 1.0, None), (None, "b", None, None, None, 1.0, 5)]
    changes = [(1, "c", None, None, None, 1.0, 3), (None, "d", None, None, None, 1.0, 6)]
    assert rows_of(merged_snapshot(table(spark, snapshot), table(spark, changes), "id", "timestamp")) == sorted(
        changes, key=repr
    )


VERSIONED = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 100)), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VERSIONED, VERSIONED)
def test_merge_against_a_loop(spark, old, new):
    schema = "id int, v int, name int"
    snapshot, newest = {}, {}
    for target, rows in ((snapshot, old), (newest, new)):
        for row in rows:
            target[row[0]] = max(target.get(row[0], row), row)
    want = dict(snapshot)
    for key, row in newest.items():
        if key not in want or row[1] >= want[key][1]:
            want[key] = row
    snap = latest_per_key(spark.createDataFrame(old, schema), "id", "v")
    merged = merged_snapshot(snap, spark.createDataFrame(new, schema), "id", "v")
    assert rows_of(merged) == sorted(want.values(), key=repr)


def test_latest_limits_before_the_shuffle(spark, plan_of):
    assert "WindowGroupLimit" in plan_of(latest_per_key(table(spark, CHANGES), "id", "timestamp"))


def test_job_keeps_versions(spark, folder):
    table(spark, CATALOGUE).write.json(f"{folder}/first")
    table(spark, CHANGES).write.json(f"{folder}/changes")
    base = f"{folder}/catalogue"
    assert current_version(spark, base) == 0
    assert run_product_merge(spark, f"{folder}/first", base) == 1
    assert rows_of(read_snapshot(spark, base)) == sorted(CATALOGUE, key=repr)
    assert run_product_merge(spark, f"{folder}/changes", base) == 2
    assert rows_of(read_snapshot(spark, base)) == MERGED
    # A run that died after writing its rows leaves the current version; the next run replaces them.
    table(spark, CATALOGUE[:1]).write.parquet(f"{base}/data/version=3/bucket=0")
    assert rows_of(read_snapshot(spark, base)) == MERGED
    assert run_product_merge(spark, f"{folder}/changes", base) == 3
    assert rows_of(read_snapshot(spark, base)) == MERGED
    assert rows_of(read_snapshot(spark, base, 1)) == sorted(CATALOGUE, key=repr)
    assert run_product_merge(spark, f"{folder}/changes", base, keep_versions=2) == 4
    assert sorted(os.listdir(f"{base}/manifests")) == ["version=3", "version=4"]
    assert rows_of(read_snapshot(spark, base)) == rows_of(read_snapshot(spark, base, 3)) == MERGED


def test_few_changes_rewrite_few_buckets(spark, folder):
    base = f"{folder}/catalogue"

    def product(number, name, at):
        return (number, name, "hat", "lcw", "blue", 1.0, at)

    def merge(rows, **options):
        nonlocal runs
        runs += 1
        table(spark, rows).write.json(f"{folder}/records/{runs}")
        return run_product_merge(spark, f"{folder}/records/{runs}", base, buckets=16, **options)

    def written(version):
        path = f"{base}/data/version={version}"
        return {name for name in os.listdir(path) if name.startswith("bucket")} if os.path.exists(path) else set()

    runs = 0
    first = [product(n, "old", 10) for n in range(400)] + [product(None, "none", 10)]
    assert merge(first) == 1 and len(written(1)) == 16
    # Two newer records, a late one that loses, and one that is there already.
    assert merge([product(7, "new", 11), product(9, "new", 11), product(11, "late", 9), first[20]]) == 2
    assert 1 <= len(written(2)) <= 2
    changed = manifest(spark, base, 2)
    assert {f"bucket={b}" for b, v in changed.items() if v == 2} == written(2)
    want = sorted([r for r in first if r[0] not in (7, 9)] + [product(7, "new", 11), product(9, "new", 11)], key=repr)
    assert rows_of(read_snapshot(spark, base)) == want
    assert rows_of(read_snapshot(spark, base, 1)) == sorted(first, key=repr)
    # Late and repeated records write nothing; an empty file makes a version with the same rows.
    assert merge([product(7, "late", 10), product(9, "new", 11)]) == 3 and written(3) == set()
    assert merge([]) == 4 and written(4) == set()
    assert rows_of(read_snapshot(spark, base)) == want
    # A null id and a new one; only folders that no kept version names go.
    assert merge([product(None, "known", 12), product(1000, "added", 1)], keep_versions=1) == 5
    want = sorted([r for r in want if r[0] is not None] + [product(None, "known", 12), product(1000, "added", 1)], key=repr)
    assert rows_of(read_snapshot(spark, base)) == want
    assert len(written(1) | written(2) | written(5)) == 16 == sum(len(written(v)) for v in (1, 2, 5))


def test_first_merge_of_nothing(spark, folder):
    table(spark, []).write.json(f"{folder}/none")
    assert run_product_merge(spark, f"{folder}/none", f"{folder}/catalogue") == 1
    assert read_snapshot(spark, f"{folder}/catalogue").count() == 0
