"""Table-usage inventory on small scripts written for the test."""

import pytest

from ledgerline.plans import usage

PROC = """
-- staging
WITH Recent AS (
    SELECT o.OrderId FROM Orders o WHERE o.OrderDate >= @d
)
INSERT INTO #Stage (OrderId, Amount)
SELECT r.OrderId, SUM(od.Qty * od.Price)
FROM Recent r
INNER JOIN [dbo].[OrderLines] od ON od.OrderId = r.OrderId
LEFT JOIN Products p ON p.ProductId = od.ProductId
GROUP BY r.OrderId;

UPDATE s
SET Amount = (SELECT MAX(x.Amount) FROM Archive x WHERE x.OrderId = s.OrderId),
    Status = 'Done'
FROM #Stage s
JOIN Orders o2 ON o2.OrderId = s.OrderId;

/* a block comment
   over two lines; with a semicolon */DELETE FROM Queue WHERE QueueId IN (SELECT q.QueueId FROM Queue q JOIN Orders o3 ON o3.OrderId = q.OrderId);

MERGE Summary AS target
USING (SELECT OrderId, Amount FROM #Stage) AS source
ON target.OrderId = source.OrderId
WHEN MATCHED AND target.Amount <> source.Amount THEN UPDATE SET Amount = source.Amount
WHEN NOT MATCHED BY TARGET THEN INSERT (OrderId, Amount) VALUES (source.OrderId, source.Amount)
WHEN NOT MATCHED BY SOURCE THEN DELETE
OUTPUT $action INTO #MergeLog;

IF EXISTS (SELECT 1 FROM sys.procedures WHERE name = 'x; -- not a statement end') SELECT 1;
"""

ADHOC = """
select * from (select * from sales.tb01) a,
sales.tb02 b, tb03 c, remote_tb@link1 d
where a.id = b.id

merge into aaa.Summary2
using (
select * from bbb.Summary3
) as source
on target.k = source.k
when matched then
update set target.v = source.v,
target.w = source.w
"""


@pytest.fixture(scope="module")
def refs(spark):
    scripts = spark.createDataFrame([("proc", PROC), ("adhoc", ADHOC)], "script_id string, text string")
    return scripts, usage.references(scripts).cache()


def _usage(refs, script):
    return {(r.type, r.name) for r in usage.table_usage(refs).filter(f"script_id = '{script}'").collect()}


def test_table_usage_proc(refs):
    _, r = refs
    got = _usage(r, "proc")
    assert got == {
        ("select", "Orders"), ("select", "OrderLines"), ("select", "Products"), ("insert", "#Stage"),
        ("select", "Archive"), ("select", "#Stage"), ("update", "#Stage"),
        ("select", "Queue"), ("delete", "Queue"),
        ("merge", "Summary"), ("update", "Summary"), ("insert", "Summary"), ("delete", "Summary"),
        ("insert", "#MergeLog"),
    }


def test_table_usage_adhoc(refs):
    _, r = refs
    got = _usage(r, "adhoc")
    assert got == {("select", "tb01"), ("select", "tb02"), ("select", "tb03"), ("select", "remote_tb"),
                   ("select", "Summary3"), ("merge", "Summary2"), ("update", "Summary2")}


def test_classes_aliases_counts(refs):
    scripts, r = refs
    classes = {(x.name, x["class"]) for x in usage.table_usage(r).filter("script_id = 'proc'").collect()}
    assert ("#Stage", "temporary") in classes and ("Orders", "permanent") in classes
    aliases = {x.name: x.aliases for x in usage.alias_lists(r).filter("script_id = 'proc'").collect()}
    assert aliases["Orders"] == ["o", "o2", "o3"]
    counts = {x.type: (x.permanent, x.temporary) for x in usage.type_counts(r).filter("script_id = 'proc'").collect()}
    assert counts["insert"] == (1, 2) and counts["update"] == (1, 1)
    top = usage.most_used(r).filter("script_id = 'proc'").first()
    assert (top.name, top.reads) == ("Orders", 3)


def test_lineage_ranges_columns_merge(refs):
    scripts, r = refs
    edges = {(e.verb, e.target, e.source) for e in usage.lineage_edges(r).filter("script_id = 'proc'").collect()}
    assert ("insert", "#Stage", "OrderLines") in edges and ("update", "#Stage", "Archive") in edges
    ranges = {(x.verb, x.target): (x.first_line, x.last_line)
              for x in usage.statement_ranges(scripts, r).filter("script_id = 'proc'").collect()}
    assert ranges[("insert", "#Stage")] == (3, 11)
    assert ranges[("delete", "Queue")] == (20, 20)
    cols = {x.target: x.columns for x in usage.updated_columns(scripts, r).collect()}
    assert cols["#Stage"] == ["Amount", "Status"]
    acts = {(x.target, x.branch, x.action, x.output_into) for x in usage.merge_actions(scripts, r).collect()}
    assert ("Summary", "MATCHED", "UPDATE", "#MergeLog") in acts
    assert ("Summary", "NOT MATCHED BY SOURCE", "DELETE", "#MergeLog") in acts
    assert ("Summary2", "MATCHED", "UPDATE", None) in acts
    assert usage.update_counts(r).filter("name = '#Stage'").first().updates == 1
    top = usage.complexity(r).first()
    assert top.tables >= 4


def test_blanks_after_delete_are_no_read(spark):
    scripts = spark.createDataFrame([("s", "DELETE" + " " * 25 + "FROM Sessions WHERE 1 = 0;")], "script_id string, text string")
    got = {(r.type, r.name) for r in usage.table_usage(usage.references(scripts)).collect()}
    assert got == {("delete", "Sessions")}
