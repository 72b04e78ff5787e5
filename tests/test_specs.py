import pytest

from batchwright.plans import driver_registry, reference_basic_registry, reference_batch_registry
from batchwright.specs import SCD, Registry, SpecError, TableSpec, UnknownTableError, load_order


def test_reference_registries_parse(spark):
    batch = reference_batch_registry()
    assert len(batch.names()) == 9
    assert [s.name for s in batch if s.load == SCD] == ["customer", "customer_address", "household_demographics"]
    assert len(batch["store"].columns) == 29 and len(batch["store_sales"].columns) == 23
    basic = reference_basic_registry()
    assert basic["customer"].target == "customers"
    assert len(basic["customer_demographics"].columns) == 9


def test_output_columns(spark):
    reg = driver_registry()
    assert reg["customer"].output_columns[-2:] == ["start_date", "end_date"]
    assert reg["orders"].output_columns[-1] == "batched_at"


@pytest.mark.parametrize(
    "spec",
    [
        TableSpec("t", "a int", "merge"),
        TableSpec("t", "a int", "scd"),
        TableSpec("t", "a int, b int", "scd", "a"),
        TableSpec("t", "a int, b int", "scd", "a", ("c",)),
        TableSpec("t", "a int, batched_at date", "append"),
    ],
)
def test_invalid_specs(spark, spec):
    with pytest.raises(SpecError):
        Registry.of([spec])


def test_unknown_table(spark):
    reg = driver_registry()
    with pytest.raises(UnknownTableError):
        reg["store_returns"]
    with pytest.raises(UnknownTableError):
        reg.check_tables(["customer", "store_returns"])


def test_fact_loads_last(spark):
    order = [s.name for s in load_order(driver_registry())]
    assert order.index("orders") > order.index("customer") > order.index("part")
