import pytest
from conftest import rows
from pyspark.sql import functions as F

from snaptide.sources import tables
from snaptide.sources.tables import broken_tables, table_cells, table_grid


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


def grid(spark, html, table_class=None):
    cells = table_cells(pages(spark, html), ["page_id"], table_class=table_class)
    return [tuple(r)[1:] for r in table_grid(cells, ["page_id"]).orderBy("table_no", "row_no").collect()]


NESTED = """<p>before</p><table class="outer big"><tr><th>Team</th><th>Home &amp; away</th></tr>
<tr><td>One <table><tr><td>a<td>b</tr><tr><td>c <table><tr><td>deep</td></tr></table> d</td></tr></table> end</td><td>2</td></tr>
<tr><td><b>Th</b>ree<br>x</td></tr></table> between <table><tr><td>last</td></tr></table>"""


def test_tables_inside_cells(spark):
    assert grid(spark, NESTED) == [
        (0, None, 1, 0, ["Team", "Home & away"]),
        (0, None, 1, 1, ["One end", "2"]),
        (0, None, 1, 2, ["Three x"]),
        (1, 0, 2, 0, ["a", "b"]),
        (1, 0, 2, 1, ["c d"]),
        (2, 1, 3, 0, ["deep"]),
        (3, None, 1, 0, ["last"]),
    ]
    assert [r[0] for r in grid(spark, NESTED, "outer")] == [0, 0, 0] and grid(spark, NESTED, "out") == []


@pytest.mark.parametrize(
    "html, want",
    [
        # a span of rows moves the cells of the next row to the right
        ("<tr><td rowspan=2>a<td>b<tr><td>c", [["a", "b"], ["a", "c"]]),
        ("<tr><td colspan='2'>a<td>b<tr><td>c<td rowspan=\"2\" colspan=2>d<tr><td>e", [["a", "a", "b"], ["c", "d", "d"], ["e", "d", "d"]]),
        # the middle column is held from above, so the second cell of the row comes behind it
        ("<tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td>f", [["a", "b", "c"], ["d", "b", "e"], ["f", "b"]]),
        # to the end of the table, and no further
        ("<tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d", [["a", "b"], ["a", "c"], ["a", "d"]]),
        ("<tr><td rowspan=99>a<tr><td>b", [["a"], ["a", "b"]]),
        ("<tr><td rowspan=x colspan=0>a<td>b<tr>", [["a", "b"]]),
        ("<tr><td rowspan=2 colspan=2>a<td rowspan=2>b<td>c<tr><td>d<tr><td>e<td>f", [["a", "a", "b", "c"], ["a", "a", "b", "d"], ["e", "f"]]),
        ("<td>no row tag<td>b", [["no row tag", "b"]]),
        ("<TR><TH>A &lt; B</TH><td></td></TR><script>'<table>'</script><!-- <tr><td>x -->", [["A < B", ""]]),
    ],
)
def test_spans_become_a_grid(spark, html, want):
    assert [r[-1] for r in grid(spark, f"<table>{html}</table>")] == want


def plain_grid(table_rows):
    """Slot by slot, as a reader would fill the table in."""
    taken, out = {}, [[] for _ in table_rows]
    for r, cells in enumerate(table_rows):
        c = 0
        for text, down, over in cells:
            while (r, c) in taken:
                c += 1
            for y in range(r, min(r + down, len(table_rows))):
                for x in range(c, c + over):
                    taken[y, x] = text
            c += over
    for (y, x), text in taken.items():
        out[y] += [None] * (x + 1 - len(out[y]))
        out[y][x] = text
    return out


def test_spans_equal_a_plain_filling(spark):
    import random

    rng = random.Random(3)
    tables = [
        [[(f"t{r}{c}", rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2])) for c in range(rng.randrange(1, 4))] for r in range(rng.randrange(1, 6))]
        for _ in range(40)
    ]
    html = [
        "<table>" + "".join("<tr>" + "".join(f"<td rowspan={d} colspan={o}>{t}</td>" for t, d, o in cells) + "</tr>" for cells in t) + "</table>"
        for t in tables
    ]
    found = table_grid(table_cells(pages(spark, *html), ["page_id"]), ["page_id"])
    got = {(r.page_id, r.row_no): r.cells for r in found.collect()}
    # overlapping cells are an error of the page; both show one of the two there, so such tables are left out
    for i, t in enumerate(tables):
        covered = sum(d * o for cells in t for _, d, o in cells)
        want = plain_grid([[(x, min(d, len(t) - r), o) for x, d, o in cells] for r, cells in enumerate(t)])
        if sum(v is not None for row in want for v in row) == sum(min(d, len(t) - r) * o for r, cells in enumerate(t) for _, d, o in cells):
            assert [got.get((i, r)) for r in range(len(t))] == want, (i, t, covered)


def test_only_broken_pages_are_named(spark):
    df = pages(
        spark, NESTED, "<table><tr><td>x", "<table></table></table>", "no table", "<table><table></table>", "", None, "</table><table></table>", "<tablet>"
    )
    assert rows(broken_tables(df, ["page_id"])) == [(1, 1, 0), (2, 0, 1), (4, 1, 0), (7, 0, 1)]
    assert table_cells(df, ["page_id"]).where("page_id = 1").select("text").collect()[0][0] == "x"


def test_a_page_is_shuffled_once(spark):
    plan = table_cells(pages(spark, NESTED), ["page_id"])._jdf.queryExecution().executedPlan().toString()
    before_join = [line for line in plan.split("\n") if "Exchange hashpartitioning(page_id" in line]
    assert len(before_join) <= 2, plan


def test_more_pages_make_more_tasks_and_not_larger_ones(spark, monkeypatch):
    """Also where the session asks for one shuffle partition."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "1")

    def parts(copies):
        df = pages(session, *[f"{NESTED}<table><table><tr><td rowspan=2>{i}</table>" for i in range(copies)])
        cells = table_cells(df, ["page_id"])
        shown = table_grid(cells, ["page_id"])
        return rows(shown), [f.select(F.spark_partition_id()).distinct().count() for f in (cells, shown)]

    monkeypatch.setattr(tables, "_PART", 20_000)
    few, some = parts(10), parts(60)
    # by hash, so a part may be empty
    assert all(2 * a <= b >= 4 for a, b in zip(few[1], some[1], strict=True)), (few[1], some[1])
    monkeypatch.undo()
    assert parts(60) == (some[0], [1, 1])
    assert (59, 5, 4, 2, 0, ["59"]) in some[0]


def test_null_keys_and_strange_names(spark):
    df = spark.createDataFrame([(None, "<table><tr><td>a</td></tr></table>")], "`a.b` int, `the page` string")
    cells = table_cells(df, ["a.b"], "the page")
    assert rows(table_grid(cells, ["a.b"]).select("cells")) == [(["a"],)]
    assert table_cells(df.where(F.lit(False)), ["a.b"], "the page").count() == 0
