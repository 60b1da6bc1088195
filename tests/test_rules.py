import random

import pytest
from pyspark.sql import functions as F

from formweave.operators import rules
from formweave.plans.rule_load import load_rules
from formweave.schemas import RULES
from formweave.sinks.files import write_rules
from formweave.sources.rules import current_rules, rule_csv, rules_at

BASE = [
    ("purchase", "full name", "CRYPTOHASHING", ""), ("PURCHASE", "user_id", "redaction", ""),
    ("purchase", "home.city", "MASKING", "DELETED"), ("signup", "full name", "MASKING", None),
    ("signup", "tags", "Masking", "keep"), ("view", "user_id", "CRYPTOHASHING", "Deleted"),
    ("click", "Full Name", "REDACTION", ""), ("purchase", "props", "CRYPTOHASHING", ""),
    ("purchase", "props", "MASKING", ""),
]
CSV = """formName,fieldName,dlpTechnique,addnl_info
error,user_id,MASKING,
error,user_id,REDACTION,
error,user_id,MASKING,Deleted
error,user_id,REDACTION,note
purchase,full name,CRYPTOHASHING, deleted
view,user_id,MASKING,
signup,full name,MASKING,
short,row
,x,MASKING,
click,"a,b",MASKING,
"""


def fold(base, ops):
    """The changes one after the other, as a loop."""
    rows = [list(r) for r in base]
    for form, name, technique, action in ops:
        if action == "D":
            for r in rows:
                if r[:3] == [form, name, technique]:
                    r[3] = "DELETED"
        elif not any(r[:2] == [form, name] and r[3] is not None and r[3] != "DELETED" for r in rows):
            rows.append([form, name, technique, ""])
    return sorted(map(repr, map(tuple, rows)))


def test_reader_groups_fields_by_form(spark):
    grouped = {r.form_key: r for r in rules.rules_by_form(spark.createDataFrame(BASE, RULES)).collect()}
    assert sorted(grouped) == ["click", "purchase", "signup"]
    assert grouped["purchase"].cryptohashing_fields == ["full name", "props"]
    assert grouped["purchase"].redaction_fields == ["user_id"]
    assert grouped["purchase"].masking_fields == ["props"]
    assert grouped["signup"].masking_fields == ["tags"]


def test_loader_applies_a_file_in_line_order(spark, tmp_path):
    (tmp_path / "rules.csv").write_text(CSV)
    table = str(tmp_path / "table")
    write_rules(spark.createDataFrame(BASE, RULES), table, 1)
    assert load_rules(spark, str(tmp_path / "rules.csv"), table) == 2
    got = sorted(repr(tuple(r)) for r in current_rules(spark, table).collect())
    expected = [r for r in BASE if r != BASE[0]] + [
        ("purchase", "full name", "CRYPTOHASHING", "DELETED"), ("error", "user_id", "MASKING", "DELETED"),
        ("error", "user_id", "REDACTION", ""), ("signup", "full name", "MASKING", ""), ("click", "a,b", "MASKING", "")]
    assert got == sorted(map(repr, expected)) and len(got) == 13


def test_loading_into_nothing_starts_a_table(spark, tmp_path):
    (tmp_path / "rules.csv").write_text(CSV)
    load_rules(spark, str(tmp_path / "rules.csv"), str(tmp_path / "table"))
    assert current_rules(spark, str(tmp_path / "table")).count() == 5


def test_csv_cells(spark, tmp_path):
    (tmp_path / "r.csv").write_text('h1,h2,h3,h4\n"a ""q""",b\t,c,\n,b,c,d\n  ,b,c,d\na,b,c\na,b,c,d,e\n')
    rows = rule_csv(spark, str(tmp_path / "r.csv"))
    assert [r._corrupt for r in rows.collect() if r._corrupt] == ["a,b,c", "a,b,c,d,e"]
    assert rows.where("_corrupt is null").select("formName").collect()[-1].formName == "  "
    changes = rules.csv_changes(rows).orderBy("pos").collect()
    assert [(r.formName, r.fieldName, r.dlpTechnique, r.action) for r in changes] == [
        ('a "q"', "b", "c", "U"), ("", "b", "c", "U")]


@pytest.mark.parametrize("seed,block", [(1, 100_000), (2, 3), (3, 1), (4, 7)])
def test_changes_equal_a_loop(spark, monkeypatch, seed, block):
    """Random changes, half of them to one key, in blocks smaller than a key's changes."""
    monkeypatch.setattr(rules, "CHUNK_LINES", block)
    rnd = random.Random(seed)

    def key():
        return ("hot", "x") if rnd.random() < 0.5 else (rnd.choice("fg"), rnd.choice("xy"))

    base = [(*key(), rnd.choice("ABC"), rnd.choice(["", None, "DELETED", "Deleted", "n"])) for _ in range(6)]
    ops = [(*key(), rnd.choice("ABC"), rnd.choice("UUDDD")) for _ in range(160)]
    lines = [(("p", i // 40, i % 40), *op) for i, op in enumerate(ops)]
    changes = spark.createDataFrame(lines, "pos struct<file:string,block:bigint,row:bigint>, formName string, "
                                           "fieldName string, dlpTechnique string, action string")
    got = rules.apply_changes(spark.createDataFrame(base, RULES), changes.repartition(3))
    assert sorted(repr(tuple(r)) for r in got.collect()) == fold(base, ops)


def test_active_for_reader_and_loader_differ(spark):
    rows = spark.createDataFrame(BASE, RULES)
    reader, loader = rules.is_active_for_reader(), rules.is_active_for_loader()
    only_loader = rows.where(loader & ~reader).collect()
    assert [r.formName for r in only_loader] == ["view"]
    assert rows.where(reader & ~F.coalesce(loader, F.lit(False))).count() == 0


def test_a_change_of_one_key_rewrites_one_bucket(spark, tmp_path):
    table = str(tmp_path / "table")
    many = [(f"form{i}", "x", "MASKING", "") for i in range(300)]
    write_rules(spark.createDataFrame(many, RULES), table, 1)
    (tmp_path / "one.csv").write_text("h1,h2,h3,h4\nform7,x,MASKING,Deleted\nform7,x,REDACTION,\n")
    assert load_rules(spark, str(tmp_path / "one.csv"), table) == 2
    assert len(list((tmp_path / "table" / "version=2").glob("bucket=*"))) == 1
    now = {tuple(r) for r in current_rules(spark, table).collect()}
    assert now == set(many) - {many[7]} | {("form7", "x", "MASKING", "DELETED"), ("form7", "x", "REDACTION", "")}
    assert {tuple(r) for r in rules_at(spark, table, version=1).collect()} == set(many)
    # A version whose log is missing, as after a crash, is not seen; writing it again completes it.
    spark.createDataFrame([("a", "b", "c", "", 0)], "formName string, fieldName string, dlpTechnique string, "
                          "addnl_info string, bucket int").write.partitionBy("bucket").parquet(f"{table}/version=3")
    assert {tuple(r) for r in current_rules(spark, table).collect()} == now
    (tmp_path / "none.csv").write_text("h1,h2,h3,h4\n")
    assert load_rules(spark, str(tmp_path / "none.csv"), table) == 3
    assert {tuple(r) for r in current_rules(spark, table).collect()} == now
    # A table written anew has nothing of before, also in buckets that are empty now.
    write_rules(spark.createDataFrame(many[:1], RULES), table, 4)
    assert current_rules(spark, table).count() == 1


def test_rounds_of_insertions_leave_nothing_in_the_driver(spark):
    """What a plan knows of its columns must not pile up round by round, nor may the joins be broadcasts."""
    lines = [(("f", 0, n), "purchase", "x", "MASKING", "UD"[n % 2]) for n in range(256)]
    changes = spark.createDataFrame(lines, "pos struct<file:string,block:bigint,row:bigint>, formName string, "
                                           "fieldName string, dlpTechnique string, action string")
    upserts, deletions = (changes.where(F.col("action") == a).drop("action") for a in "UD")
    inserted = rules._inserting(upserts, deletions)
    assert inserted.count() == 128
    leaves = inserted._jdf.queryExecution().analyzed().collectLeaves()
    assert sum(leaves.apply(i).constraints().size() for i in range(leaves.size())) == 0
    got = rules.apply_changes(spark.createDataFrame([], RULES), changes)
    assert [(r.addnl_info, r.n) for r in got.groupBy("addnl_info").agg(F.count("*").alias("n")).collect()] == [("DELETED", 128)]
