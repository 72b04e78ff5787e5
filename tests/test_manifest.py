"""Batch folders: discovery, dates, part files, unknown tables."""

import datetime as dt
import os

import pytest

from batchwright.functions.stamps import BatchNameError, is_newer, parse_batch_date
from batchwright.sources.manifest import list_batches, manifest, manifest_frame


def _local(ws):
    return ws.replace("file:", "", 1) if ws.startswith("file:") else ws


def _part(root, batch, table, name="part-00000", text="1|a\n"):
    d = os.path.join(root, batch, table)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_batches_sorted_and_filtered(spark, ws):
    root = _local(ws)
    _part(root, "batch_2022-11-02", "customer")
    _part(root, "batch_2022-11-01", "customer")
    _part(root, "staging", "customer")
    assert list_batches(spark, root) == ["batch_2022-11-01", "batch_2022-11-02"]


def test_entries_parts_and_missing(spark, ws):
    root = _local(ws)
    _part(root, "batch_2022-11-01", "customer", "part-00000")
    _part(root, "batch_2022-11-01", "customer", "part-00001")
    _part(root, "batch_2022-11-01", "customer", "_SUCCESS", "")
    os.makedirs(os.path.join(root, "batch_2022-11-01", "item"))
    es = {e.table: e for e in manifest(spark, root)}
    assert es["customer"].n_parts == 2 and es["item"].n_parts == 0
    assert es["customer"].batch_date == dt.date(2022, 11, 1)


def test_manifest_frame_counts_records(spark, ws):
    root = _local(ws)
    _part(root, "batch_2022-11-01", "customer", "part-00000", "1|a\n2|b\n\n")
    _part(root, "batch_2022-11-01", "customer", "part-00001", "3|c\n")
    _part(root, "batch_2022-11-02", "orders", "part-00000", "1|x\n")
    got = {(r.batch, r.table_name): (r.batch_date, r.n_records) for r in manifest_frame(spark, root).collect()}
    assert got == {
        ("batch_2022-11-01", "customer"): (dt.date(2022, 11, 1), 3),
        ("batch_2022-11-02", "orders"): (dt.date(2022, 11, 2), 1),
    }


@pytest.mark.parametrize(
    "name, want",
    [
        ("batch_2022-11-01", dt.date(2022, 11, 1)),
        ("batch_2022-11-01T100000", dt.date(2022, 11, 1)),
        ("batch_2022-11-01 10:00", dt.date(2022, 11, 1)),
    ],
)
def test_batch_dates(name, want):
    assert parse_batch_date(name) == want


@pytest.mark.parametrize("name", ["batch_20221101", "batch_2022_11_01", "batch", "batch_2022-13-01", "batch_1667260800"])
def test_unreadable_batch_dates(name):
    with pytest.raises(BatchNameError):
        parse_batch_date(name)


def test_unreadable_folder_fails_discovery(spark, ws):
    root = _local(ws)
    _part(root, "batch_2022-11-01", "customer")
    _part(root, "batch_latest", "customer")
    with pytest.raises(BatchNameError):
        list_batches(spark, root)


def test_is_newer_compares_dates():
    mark = dt.date(2022, 11, 1)
    assert is_newer("batch_2022-11-02", mark)
    assert not is_newer("batch_2022-11-01T235959", mark)  # same day with a time: not new
    assert not is_newer("batch_2022-10-31", mark)
    assert is_newer("batch_2022-10-31", None)  # no mark yet: new


def test_manifest_frame_decodes_paths(spark, ws):
    """A root and a batch name with characters that file URLs encode."""
    root = os.path.join(_local(ws), "land ing+1")
    _part(root, "batch_2022-11-01 1000", "customer", "part-00000", "1|a\n2|b\n")
    got = [tuple(r) for r in manifest_frame(spark, root).collect()]
    assert got == [("batch_2022-11-01 1000", dt.date(2022, 11, 1), "customer", 2)]
