"""Text, trend and HTML functions, messages, grids, lines."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.functions import html as H
from tidemark.functions import text as X
from tidemark.functions import trends as R
from tidemark.operators import enrich as E
from tidemark.operators import messages as M
from tidemark.operators import query as Q
from tidemark.operators import series as S
from tidemark.operators import tables as TB
from tidemark.operators.running import id_block


def values(spark, inputs, fn, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_volume(spark):
    assert values(spark, ["2K+", "1M", "200+", "1.5K", "2m+", "10", "n/a", "", None], R.parse_volume) == [
        2000, 1000000, 200, 1500, 2000000, 10, None, None, None]


def test_times(spark):
    now = datetime(2021, 10, 10, 12, 0)

    def ago(c):
        return R.relative_time(c, F.lit(now).cast("timestamp_ntz"))
    assert values(spark, ["4 hours ago", "10 minutes ago", "11h ago", "2 days ago", "5 mins ago", "2 months ago", "soon", None], ago) == [
        now - timedelta(hours=4), now - timedelta(minutes=10), now - timedelta(hours=11), now - timedelta(days=2),
        now - timedelta(minutes=5), None, None, None]
    start = F.lit(datetime(2021, 10, 10, 8)).cast("timestamp_ntz")
    assert values(spark, ["Lasted 4 hours", "", "Active", None], lambda c: R.end_time(start, c)) == [
        datetime(2021, 10, 10, 12), None, None, None]
    assert values(spark, ["Active", " active ", "Lasted 3 hours", None], R.is_active) == [True, True, False, None]


def test_lists(spark):
    assert values(spark, ["a, b ,c", "", " , x", None], R.split_list) == [["a", "b", "c"], [], ["x"], None]
    assert values(spark, [["a", "b"], []], R.join_list, "ARRAY<STRING>") == ["a, b", ""]
    assert values(spark, [["games", "nope", "health"], ["nope"], [], None], R.valid_categories, "ARRAY<STRING>") == [
        ["games", "health"], ["other"], ["other"], ["other"]]
    assert len(R.TREND_CATEGORIES) == 19
    assert values(spark, ["weather · okc!", "Élan-2, x."], R.strip_special) == ["weather  okc", "Élan-2, x."]


PAGE = ('<html><body class="a>b"><svg width="1"><path d="M0"/><g><text>9</text></g></svg><table id=\'t\'><tr><td>1</td></tr>'
        '<tr><td><table><tr><td>in &amp; out</td></tr></table></td></tr></table><br/><img src="x"/><p>a < b</p></body></html>')


def test_html_regex(spark):
    assert values(spark, [PAGE, None], lambda c: H.html_remove(c, "svg"))[0] == PAGE[:PAGE.index("<svg")] + PAGE[PAGE.index("<table"):]
    stripped = values(spark, [PAGE], H.html_strip_attrs)[0]
    assert '="' not in stripped and stripped.startswith("<html><body><svg><path/><g>") and "<br/><img/><p>a < b</p>" in stripped
    assert values(spark, [PAGE], lambda c: H.html_strip_attrs(c, ["img", "path"]))[0].count('="') == 2
    assert values(spark, [PAGE, "<p>x</p>"], lambda c: H.html_element(c, "p")) == ["<html>a < b</html>", "<html>x</html>"]
    assert values(spark, ["<p>x</p>"], lambda c: H.html_element(c, "table")) == [None]


def test_html_parser_loses_no_text(spark):
    clean = lambda page, *names: values(spark, [page], lambda c: H.html_clean(c, names, strip_attrs=False))[0]
    assert clean("<?xml v?><p>a<![CDATA[b]]></p>", "svg") == "<?xml v?><p>a<![CDATA[b]]></p>"
    assert clean("<p>a<script>b", "script") == "<p>a<script>b"
    assert clean("<div><p>one<p>two</div>tail", "p") == "<div></div>tail"
    assert clean("<ul><li>a<ul><li>b</ul></li></ul>end", "ul") == "end"
    nested = "<ul><li>a<ul><li>b</ul></li><li>c</ul>"
    assert values(spark, [nested], lambda c: H.html_element_nested(c, "ul")) == ["<html><li>a<ul><li>b</ul></li><li>c</html>"]


def test_html_parser(spark):
    nested = "<div>a<div>b</div>c</div><p>d</p><!--n-->&lt;&#65;"
    assert values(spark, [nested, None], lambda c: H.html_remove_nested(c, "div")) == ["<p>d</p><!--n-->&lt;&#65;", None]
    assert values(spark, [PAGE, "<p>", None], lambda c: H.html_element_nested(c, "table")) == [
        "<html><tr><td>1</td></tr><tr><td><table><tr><td>in &amp; out</td></tr></table></td></tr></html>", None, None]
    stripped = values(spark, [PAGE], H.html_strip_attrs_parsed)[0]
    assert '="' not in stripped and "<br/><img/>" in stripped and "in &amp; out" in stripped
    assert values(spark, ['<a href="x" id=1>t</a><b id="2">u</b>'], lambda c: H.html_strip_attrs_parsed(c, ["b"])) == [
        '<a>t</a><b id="2">u</b>']
    assert values(spark, ['<img a="1"><p>x<img></p>'], lambda c: H.html_remove_nested(c, "img")) == ["<p>x</p>"]
    raw = ["<title>a &am</title>&lt;&#65;&x", '<a href="?a=1&amp;b=2&c">\ue000&amp;</a>']
    assert values(spark, raw, lambda c: H.html_clean(c, ["svg"], strip_attrs=False)) == raw
    assert values(spark, ["<!DOCTYPE html><p>"], lambda c: H.html_remove_nested(c, "svg")) == ["<!DOCTYPE html><p>"]


def test_long_attribute_does_not_overflow(spark):
    big = '<a title="' + "x y'z" * 200_000 + '" href=/q>t</a>'
    assert values(spark, [big], H.html_strip_attrs) == ["<a>t</a>"]


def test_search_text(spark):
    texts = ["hello world", "  a+b & c/d?é~!*'()-_.  ", "x" * 149 + "  tail", " \n t ﻿", "日本 \U0001F600"]

    def js(t):
        cut = t[:150].strip(" ﻿ \n\t\r")
        return f"https://s.example/q?q={quote(cut, safe=chr(33) + chr(126) + '*' + chr(39) + '()-_.')}&count=50&offset=50&responseFilter=Webpages&safesearch=Strict"
    assert values(spark, texts, lambda c: X.search_text(c, "https://s.example/q", 50)) == [js(t) for t in texts]


def test_json_functions(spark):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("timeout", T.IntegerType())])
    got = values(spark, ['{"name":"x","timeout":5}', "{bad", "", None], lambda c: X.parse_json_or_default(c, schema))
    assert [tuple(r) for r in got] == [("x", 5), (None, None), (None, None), (None, None)]
    got = values(spark, ['{"name":"a"}\n{"name":"b"}', '{"name":"c"}'], lambda c: X.first_json_line(c, schema)["name"])
    assert got == ["a", "c"]
    assert values(spark, ['{"desired":{"k":1}}', '{"k":2}'], lambda c: X.json_path_or_root(c, "desired")) == ['{"k":1}', '{"k":2}']
    assert values(spark, ["v"], lambda c: X.json_message("k", c)) == ['{"k":"v"}']
    assert values(spark, ["7908C820"], lambda c: X.tag_message(c, F.lit("Normal: $10.00"))) == [
        '{"Tag":{"Serial":"7908C820","Price":"Normal: $10.00"}}']


def test_car_message(spark):
    line = "2018-04-08 10:31:37.690665,694.99,30.32,-97.75,7.48,61.136,-0.4,8,2140,-0.01,-0.03"
    got = values(spark, [line, "a,b", None], X.split_message)
    assert got[0]["speed"] == pytest.approx(61.136) and got[0]["rpm"] == 2140 and got[0]["throttle"] == 8
    assert got[0]["acceleration"] == pytest.approx(-0.03) and got[1]["speed"] is None


def block_reader(block, keep_nul):
    """What a reader that looks at the current byte and then takes the next one returns."""
    text, i = "", 0
    while i < len(block) and block[i] not in (0, 254) and i < 20:
        i += 1
        nxt = block[i] if i < len(block) else None
        if i != 1 and nxt is not None and nxt != 254 and (nxt != 0 or keep_nul):
            text += chr(nxt)
    return text


def test_block_to_text(spark):
    rnd = random.Random(1)
    blocks = [[3, 7, 65, 66, 254, 67], [3, 7, 65, 66, 0, 67], [0, 7, 65], [3, 254, 65], [3, 0, 65], [3], [], [3, 7, 65, 66],
              [3, 7] + [70] * 40] + [[rnd.choice([0, 254, 65, 97, 120, 57, 80, 81, 82]) for _ in range(16)] for _ in range(60)]
    for keep in (False, True):
        assert values(spark, blocks, lambda c: X.block_to_text(c, keep, 20), "ARRAY<INT>") == [block_reader(b, keep) for b in blocks]
    assert values(spark, [[3, 7] + [70] * 40], X.block_to_text, "ARRAY<INT>") == ["F" * 40]


def test_bytes(spark):
    assert values(spark, [bytearray(b"\x79\x08\xc8\x20\x01")], lambda c: X.bytes_to_hex(c, 8), "BINARY") == ["7908C820"]
    assert values(spark, [bytearray("aé日".encode())], X.utf8_decode, "BINARY") == ["aé日"]
    assert values(spark, [1.0, float("nan"), None], X.nan_to_null, "DOUBLE") == [1.0, None, None]
    assert values(spark, ["ab"], X.to_binary) == [b"ab"]
    ids = values(spark, ["a", "b"], lambda c: X.random_id())
    assert len(set(ids)) == 2 and all(len(i) == 36 for i in ids)


def test_nan_is_not_null(spark):
    df = spark.sql("SELECT 1 AS idx, float('NaN') AS col_numeric UNION ALL SELECT 2, NULL UNION ALL SELECT 3, 1 UNION ALL SELECT 4, 999")
    assert rows(df.filter(F.isnan("col_numeric")), "idx") == [(1,)]
    assert rows(df.filter("col_numeric IS NULL"), "idx") == [(2,)]


def test_routes(spark):
    df = spark.createDataFrame([("Sim", "a"), ("Filter", "out.1"), ("Filter", "outx1"), ("Other", "a")], "module STRING, output STRING")
    rules = ['FROM /messages/modules/Sim/outputs/* INTO BrokeredEndpoint("/modules/Filter/inputs/in")',
             "FROM /messages/modules/Filter/outputs/* INTO $upstream", "FROM /messages/modules/Filter/outputs/out.1 INTO log"]
    assert rows(M.route(df, rules), "module", "output", "sink") == [
        ("Filter", "out.1", "$upstream"), ("Filter", "out.1", "log"), ("Filter", "outx1", "$upstream"),
        ("Sim", "a", "/modules/Filter/inputs/in")]
    with pytest.raises(ValueError, match="not a route"):
        M.route(df, ["FROM nowhere"])


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_request_reply(spark, hot_rows):
    t0 = datetime(2024, 1, 1)
    req = spark.createDataFrame([(i, t0) for i in range(5)], "request_id INT, ts TIMESTAMP_NTZ")
    at = [(0, 60, "edge"), (1, 61, "late"), (2, 5, "first"), (2, 7, "second"), (2, -1, "early"), (3, 70, "x"), (3, 80, "y"),
          (3, 90, "z"), (9, 1, "stray")]
    rep = spark.createDataFrame([(i, t0 + timedelta(seconds=s), r) for i, s, r in at], "request_id INT, ts TIMESTAMP_NTZ, result STRING")
    got = M.request_reply(req, rep, hot_rows=hot_rows)
    assert rows(got, "request_id", "result", "error") == [
        (0, "edge", None), (1, None, "TIMEOUT"), (2, "first", None), (3, None, "TIMEOUT"), (4, None, "TIMEOUT")]
    assert rows(M.reply_once(rep), "request_id", "result") == [(0, "edge"), (1, "late"), (2, "early"), (3, "x"), (9, "stray")]


def test_worker_defaults(spark):
    df = spark.createDataFrame([("Bob", 5), (None, None), ("", 0)], "name STRING, timeout INT")
    assert rows(M.with_defaults(df, name="John Doe", timeout=0)) == [("Bob", 5), ("John Doe", 0), ("John Doe", 0)]


def test_lookup(spark):
    prices = spark.createDataFrame([("7908C820", "Normal: $10.00"), ("8804399D", "Zombie: $15.50"), ("88041B9D", "Skeleton: $20.00")],
                                   "serial STRING, price STRING")
    tags = spark.createDataFrame([("8804399D",), ("FFFFFFFF",)], "serial STRING")
    assert rows(TB.lookup(tags, prices, "serial")) == [("8804399D", "Zombie: $15.50"), ("FFFFFFFF", None)]
    patch = spark.createDataFrame([("7908C820", "Normal: $12.00"), ("00000000", "x")], "serial STRING, price STRING")
    assert rows(TB.lookup_update(prices, patch, "serial", "price")) == [
        ("7908C820", "Normal: $12.00"), ("88041B9D", "Skeleton: $20.00"), ("8804399D", "Zombie: $15.50")]


def test_key_value_store(spark):
    store = spark.createDataFrame([("a", "1"), ("b", "2")], "key STRING, value STRING")
    log = spark.createDataFrame([(1, "a", "9", 2), (2, "a", "8", 2), (3, "b", None, 1), (4, "c", "x", 2), (5, "d", "y", 2), (6, "d", None, 1)],
                                "seq INT, key STRING, value STRING, op INT")
    got = TB.kv_upsert(store, log)
    assert rows(got) == [("a", "8"), ("c", "x")]
    assert rows(TB.kv_get(got, "c")) == [("c", "x")] and rows(TB.kv_delete(got, "c")) == [("a", "8")]


def test_pages_near_and_far(spark):
    df = spark.range(0, 30_000, 3).select((F.col("id") * 7).alias("k"))
    near = Q.page(df, "k", 100)
    far = Q.page(df, "k", 9_990, 20, id_block("k", 5_000))
    assert [r["k"] for r in near.collect()] == [i * 21 for i in range(100, 150)]
    assert [r["k"] for r in far.collect()] == [i * 21 for i in range(9_990, 10_000)]
    assert Q.query_by_param(spark, "SELECT k FROM {t} WHERE k = :id", {"id": 42}, t=df).collect()[0]["k"] == 42


GRID = [(kp, ki, kd, 10 * kp + ki - kd) for kp in (1.0, 2.0) for ki in (0.0, 0.5) for kd in (0.1, 0.2)]


def test_grid(spark):
    grid = spark.createDataFrame(GRID, "kp DOUBLE, ki DOUBLE, kd DOUBLE, reward DOUBLE")
    params = ["kp", "ki", "kd"]
    assert rows(S.best_params(grid, params, (9, 9, 9))) == [(2.0, 0.5, 0.1, 20.4)]
    tied = grid.withColumn("reward", F.lit(5.0))
    assert rows(S.best_params(tied, params, (9, 9, 9))) == [(1.0, 0.0, 0.1, 5.0)]
    assert rows(S.best_params(grid.withColumn("reward", F.lit(0.0)), params, (9, 8, 7))) == [(9.0, 8.0, 7.0, 0.0)]
    assert rows(S.cross_grid({p: F.col(p) for p in params}, grid)) == [r[:3] for r in GRID]
    wide = S.grid_pivot(grid, "kp", "ki", [0.0, 0.25, 0.5]).orderBy("kp").collect()
    assert [round(x, 6) for x in wide[0]] == [1.0, 9.85, 0.0, 10.35]
    avg = {(r["param"], r["value"]): round(r["avg_reward"], 6) for r in S.avg_by_param(grid, params).collect()}
    assert avg[("kp", 1.0)] == 10.1 and avg[("kd", 0.2)] == 15.05 and len(avg) == 6
    assert [r["ki"] for r in S.distinct_values(grid, "ki").collect()] == [0.0, 0.5]
    steps = spark.createDataFrame([(i, 1.0) for i in range(0, 301)], "episode INT, total_reward DOUBLE")
    assert [r["episode"] for r in S.every_nth(steps, 100).orderBy("episode").collect()] == [0, 100, 200, 300]


def test_lines_and_batches(spark):
    docs = spark.createDataFrame([(1, "a\r\nb\nc"), (2, ""), (3, "\n".join(str(i) for i in range(2500)))], "doc_id INT, body STRING")
    lines = E.lines_of(docs, "doc_id", "body")
    assert rows(lines.filter("doc_id < 3")) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "")]
    batches = E.throttle_batches(lines).filter("doc_id = 3").groupBy("batch").count()
    assert batches.count() == 250 and {r["count"] for r in batches.collect()} == {10}
    same = E.throttle_batches_by_order(lines, 10, ["doc_id"], ["idx"], id_block("idx", 100), 50)
    assert rows(same) == rows(E.throttle_batches(lines))
    done = E.enrich(lines, lambda part: [f"<{v}>" for v in part], "line", "answer", batch_size=7, parallelism=3)
    text = {r["doc_id"]: r["text"] for r in E.ordered_collect(done, "doc_id", "idx", "answer").collect()}
    assert text[1] == "<a>\n<b>\n<c>" and text[2] == "<>" and text[3] == "\n".join(f"<{i}>" for i in range(2500))


def test_lines_of_any_length_are_written_in_order(spark, folder):
    lines = spark.range(5000).select(F.lit("f").alias("file"), F.col("id").alias("idx"), F.col("id").cast("string").alias("v"))
    E.write_lines_in_order(lines.repartition(7), f"{folder}/out", ["file", "idx"], "v")
    parts = sorted(p for p in os.listdir(f"{folder}/out") if p.startswith("part-"))
    text = "".join(open(f"{folder}/out/{p}").read() for p in parts)
    assert text.split("\n")[:-1] == [str(i) for i in range(5000)]


def test_enrich_checks_its_function(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i INT, v STRING").coalesce(1)
    sizes = E.enrich(df, lambda part: [len(part)] * len(part), "v", "n", "bigint", batch_size=2)
    assert {r["n"] for r in sizes.collect()} <= {1, 2}
    with pytest.raises(Exception, match="0 results for"):
        E.enrich(df, lambda part: [], "v", "x").collect()


def test_list_envelope(spark):
    docs = spark.createDataFrame([(i, f"s{i}") for i in range(25)], "id INT, source STRING")
    got = {r["page"]: r for r in E.list_envelope(docs, "id", id_block("id", 4), ["id", "source"], 10).collect()}
    assert {p: r["n"] for p, r in got.items()} == {0: 10, 1: 10, 2: 5}
    assert got[2]["body"].startswith('{"Documents":[{"id":20,"source":"s20"},') and got[2]["body"].endswith('],"_count":5}')
