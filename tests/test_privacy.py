import pytest
from conftest import plan_of

from vaultline.operators import privacy

SCHEMA = "customer_id string, full_name string, email string, phone string, is_deleted boolean, nationality string"
PEOPLE = [
    ("1", "JO", "jo@x.fr", "+33611112222", True, "FR"),
    ("2", "AL", "al@x.be", "+32611112222", False, "BE"),
    ("3", "MO", "mo@x.de", "+49611112222", None, None),
]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, SCHEMA).coalesce(1)


def test_views_mask_and_filter_on_clear_values(spark, people):
    accounts = spark.createDataFrame([("a", "FR7630006000011234")], "account_id string, iban string")
    moves = spark.createDataFrame([("t", "FR7630006000011234")], "transaction_id string, counterpart_iban string")
    tables = {"customers": people, "accounts": accounts, "transactions": moves, "notes": accounts}
    views = privacy.secure_views(tables, {"data-analysts-fr"})
    assert [(r.customer_id, r.email, r.phone) for r in views["customers"].collect()] == [
        ("1", "j***@x.fr", "+336*****222")
    ]
    assert views["accounts"].first().iban == "FR76***234"
    assert views["transactions"].first().counterpart_iban == "FR76***234"
    assert views["notes"].first().iban == "FR7630006000011234"
    privacy.publish(views)
    assert spark.sql("SELECT count(*) FROM customers").first()[0] == 1
    for name in views:
        spark.catalog.dropTempView(name)


def test_all_policies_at_once_for_sql_readers(spark, people):
    accounts = spark.createDataFrame([("a", "FR7630006000011234")], "account_id string, iban string")
    moves = spark.createDataFrame([("t", "FR7630006000011234")], "transaction_id string, counterpart_iban string")
    tables = {"customers": people, "accounts": accounts, "transactions": moves}
    privacy.apply_policies(spark, tables, {"data-analysts-fr"})
    try:
        seen = spark.sql("SELECT full_name, email, phone FROM customers").collect()
        assert [tuple(r) for r in seen] == [("ANONYMIZED", "d***@anonymized.com", "0000*****000")]
        assert spark.sql("SELECT mask_iban(iban) FROM accounts").first()[0] == "FR76***234"
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def test_nobody_sees_nothing_and_engineers_everything(people):
    policy = privacy.POLICIES["customers"]
    assert privacy.secure_view(people, policy).count() == 0
    assert [tuple(r) for r in privacy.secure_view(people, policy, ["data-engineers"]).collect()] == PEOPLE


def test_policies_on_missing_columns_or_tables_fail(people):
    with pytest.raises(ValueError, match="iban"):
        privacy.secure_view(people, privacy.POLICIES["accounts"])
    with pytest.raises(ValueError, match="accounts"):
        privacy.secure_views({"customers": people})


def test_row_filter_reaches_the_scan_and_groups_leave_no_trace(spark, people, scratch):
    people.write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    policy = privacy.POLICIES["customers"]
    assert "EqualTo(nationality,FR)" in plan_of(privacy.secure_view(stored, policy, {"data-analysts-fr"}))
    clear = plan_of(privacy.secure_view(stored, policy, {"data-engineers"}))
    assert "Project" not in clear and "PushedFilters: []" in clear


def test_anonymize_touches_only_rows_known_to_be_deleted(people):
    rows = [tuple(r)[:4] for r in privacy.anonymize(people).collect()]
    assert rows == [
        ("1", "ANONYMIZED", "deleted_1@anonymized.com", "0000000000"),
        PEOPLE[1][:4],
        PEOPLE[2][:4],
    ]
    assert privacy.anonymize(people).columns == people.columns
