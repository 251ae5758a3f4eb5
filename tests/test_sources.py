from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sprintmart import schemas
from sprintmart.plans.extracts import customers_extract, squads_extract, teams_extract
from sprintmart.sources.pages import (
    bridge,
    flatten,
    flatten_open,
    page_records,
    parse_pages,
    read_pages,
    write_jsonl,
)
from sprintmart.sources.workspace import TreeRules, select_lists, tasks_of_lists


def pages(spark, schema, *docs):
    return parse_pages(spark.createDataFrame([(json.dumps(x),) for x in docs], "j string"), "j", schema)


def member(i, **props):
    return {"id": str(i), "createdAt": None, "archived": False, "properties": {"member_email": f"{i}@x", **props}}


def test_pages_from_files_keep_every_page(spark, tmp_path):
    for n in range(3):
        page = {"results": [member(n * 2), member(n * 2 + 1)], "paging": {"next": {"after": str(n)}}}
        (tmp_path / f"{n}.json").write_text(json.dumps(page))
    got = page_records(read_pages(spark, str(tmp_path), schemas.MEMBER_PAGE))
    assert sorted(r.id for r in got.collect()) == list("012345")
    assert got.columns[:4] == ["id", "createdAt", "updatedAt", "archived"]


def test_empty_page_folder_keeps_the_shape(spark, tmp_path):
    got = page_records(read_pages(spark, str(tmp_path), schemas.TEAM_PAGE))
    assert got.count() == 0 and got.columns[-1] == "squad_name"


def test_bridge_with_no_one_and_three_links(spark):
    docs = [
        {"record_id": "a", "results": []},
        {"record_id": "b", "results": [{"id": "1"}]},
        {"record_id": "c", "results": [{"id": "1"}, {"id": "2"}, {"id": "3"}]},
        {"record_id": "d", "results": None},
    ]
    got = bridge(pages(spark, schemas.ASSOCIATION_PAGE, *docs), "r", "t").collect()
    assert sorted(map(tuple, got)) == [("b", "1"), ("c", "1"), ("c", "2"), ("c", "3")]


def test_flatten_uses_dotted_names(spark):
    df = spark.sql("select 1 id, named_struct('status', named_struct('status', 'x'), 'n', array(1)) t")
    flat = flatten(df)
    assert flat.columns == ["id", "t.status.status", "t.n"]
    assert tuple(flat.first()) == (1, "x", [1])


def test_tree_rules(spark):
    def folder(name, *lists):
        return {"id": name, "name": name, "lists": [{"id": f"{name}/{x}", "name": x} for x in lists]}

    tree = {
        "spaces": [
            {"name": "Skip", "folders": [folder("a", "Sprint 1")]},
            {"name": "Main", "folders": [folder("Sprints", "Sprint 1", "Sprint 2"), folder("b", "Sprint 1")]},
            {"name": "Else", "folders": [folder("c", "x", "y"), {"id": "e", "name": "e", "lists": []}]},
        ]
    }
    lists = select_lists(
        pages(spark, schemas.WORKSPACE, tree), TreeRules(("Skip",), "Main", "Sprints", "Sprint 2")
    )
    assert sorted(r.list_id for r in lists.collect()) == ["Sprints/Sprint 2", "c/x", "c/y"]
    everything = select_lists(pages(spark, schemas.WORKSPACE, tree), TreeRules())
    assert everything.count() == 6
    docs = [{"list_id": "c/x", "tasks": [{"id": "1"}, {"id": "2"}]}, {"list_id": "b/Sprint 1", "tasks": [{"id": "3"}]}]
    found = tasks_of_lists(pages(spark, schemas.TASK_PAGE, *docs), lists)
    assert sorted(r.id for r in found.collect()) == ["1", "2"]


def test_squads_extract_keeps_members_without_team(spark):
    members = pages(spark, schemas.MEMBER_PAGE, {"results": [member(1), member(2), member(3)]})
    links = pages(
        spark,
        schemas.ASSOCIATION_PAGE,
        {"record_id": "1", "results": [{"id": "t1"}, {"id": "t2"}, {"id": "gone"}]},
        {"record_id": "2", "results": [{"id": "gone"}]},
    )
    team = [{"id": t, "properties": {"squad_name": t.upper()}} for t in ("t1", "t2", "t3")]
    squads, teams = squads_extract(members, links, pages(spark, schemas.TEAM_PAGE, {"results": team}))
    got = sorted((r.id, r.team_id, r.squad_name) for r in squads.collect() if r.team_id)
    assert got == [("1", "t1", "T1"), ("1", "t2", "T2")]
    assert sorted(r.id for r in squads.collect()) == ["1", "1", "2", "3"]
    assert teams.count() == 3


def test_customers_extract_fans_out(spark):
    customers = pages(
        spark, schemas.CUSTOMER_PAGE, {"results": [{"id": c, "properties": {"customer_name": c}} for c in "abc"]}
    )
    bought = pages(
        spark,
        schemas.ASSOCIATION_PAGE,
        {"record_id": "a", "results": [{"id": "p1"}, {"id": "p2"}]},
        {"record_id": "b", "results": [{"id": "p1"}, {"id": "gone"}]},
    )
    purchases = pages(
        spark,
        schemas.PURCHASE_PAGE,
        {"results": [{"id": p, "properties": {"hs_object_id": p, "service_name": p.upper()}} for p in ("p1", "p2", "p3")]},
    )
    owned = pages(spark, schemas.ASSOCIATION_PAGE, {"record_id": "p1", "results": [{"id": "t1"}, {"id": "t2"}]})
    teams = teams_extract(
        pages(spark, schemas.TEAM_PAGE, {"results": [{"id": t, "properties": {"squad_name": t.upper()}} for t in ("t1", "t2")]})
    )
    got = customers_extract(customers, bought, purchases, owned, teams)
    rows = sorted((r.id, r.service_name or "", r.squad_name or "") for r in got.collect())
    assert rows == [
        ("a", "P1", "T1"), ("a", "P1", "T2"), ("a", "P2", ""),
        ("b", "", ""), ("b", "P1", "T1"), ("b", "P1", "T2"),
        ("c", "", ""),
    ]


def test_extract_of_nothing(spark):
    empty = {s: pages(spark, s_, {"results": []}) for s, s_ in {
        "m": schemas.MEMBER_PAGE, "a": schemas.ASSOCIATION_PAGE, "t": schemas.TEAM_PAGE}.items()}
    squads, teams = squads_extract(empty["m"], empty["a"], empty["t"])
    assert squads.count() == 0 and teams.count() == 0 and "squad_name" in squads.columns
    assert squads.select(F.col("member_email")).count() == 0


def test_open_documents_keep_every_field(spark):
    docs = ['{"a": 1, "b": {"c": "x"}}', '{"a": 2, "b": {"d": true, "e": [1, 2]}}', '{"f": {"g": {"h": 1.5}}, "z": null}', '{"a": "one"}', None]
    df = spark.createDataFrame([(j,) for j in docs], "j string")
    got = flatten_open(df, "j")
    assert set(got.columns) == {"a", "b.c", "b.d", "b.e", "f.g.h", "z"}
    rows = [r.asDict() for r in got.collect()]
    assert [r["a"] for r in rows] == ["1", "2", None, '"one"', None]
    assert [r["b.d"] for r in rows] == [None, True, None, None, None]
    assert [float(r["f.g.h"]) for r in rows if r["f.g.h"] is not None] == [1.5]
    assert rows[1]["b.e"] == [1, 2]
    assert flatten_open(df.limit(0), "j").columns == []
    with pytest.raises(TypeError):
        flatten_open(spark.createDataFrame([("[1]",)], "j string"), "j")
    with pytest.raises(Exception, match="MALFORMED"):
        flatten_open(spark.createDataFrame([("{",)], "j string"), "j")


def test_only_the_folders_of_chosen_lists_are_read(spark, tmp_path):
    rows = [(f"l {i}", [{"id": str(i), "name": f"t{i}"}]) for i in range(6)]
    pages = spark.createDataFrame(rows, "list_id string, tasks array<struct<id:string,name:string>>")
    write_jsonl(pages, str(tmp_path / "tasks"), by="list_id")
    landed = read_pages(spark, str(tmp_path / "tasks"), schemas.TASK_PAGE, "tasks")
    tree = '{"spaces": [{"name": "D", "folders": [{"name": "f", "lists": [{"id": "l 2", "name": "two"}, {"id": "l 4", "name": "no"}]}]}]}'
    tree_rows = spark.createDataFrame([(tree,)], "t string").select(F.from_json("t", schemas.WORKSPACE).alias("w")).select("w.*")
    found = tasks_of_lists(landed, select_lists(tree_rows, TreeRules((), "D", "f", "two")))
    assert [r.id for r in found.collect()] == ["2"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
