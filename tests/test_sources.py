import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from handbill.operators.admission import budget_admission
from handbill.sources import jsonld, listings, pages
from handbill.sources.parsers import PARSERS, parse_pages
from handbill.schema import RAW_SCHEMA

RUN = datetime(2026, 6, 5, 12, 0)

TABLE_HTML = """<body><a class="menu" href="/wydarzenia/">all</a>
<a class="row clearfix" href="/wydarzenia/one">
 <div class="colTab date"><span class="num">10.06</span> Sr</div>
 <div class="colTab title"><div><span>AI</span> evening</div> &amp; more
   <span class="topics">ML, <span>LLM</span></span></div>
 <div class="colTab city"> Gdynia </div><div class="colTab cost">Bezp&#322;atne, bezpł.</div>
 <div class="colTab type">meetup</div></a>
<a href="https://x.example/wydarzenia/two" class="clearfix">
 <div class="colTab title">Second</div><span class="num">1.02</span></a>
<a class="clearfix" href="/wydarzenia/none"><div class="colTab date">1.01</div></a></body>"""

CARD_HTML = """<body><section><div class="event__item big">
 <a class="event__item__title" href="/imprezy/a"><span class="event__item__title__name">Show
 ( 3 opinie )</span></a>
 <span class="calendar-icon__icon__month">cze</span><span class="calendar-icon__icon__day">7</span>
 <p class="event__item__date__hour">godz. 18:00</p>
 <span class="event__item__location__city">Gdańsk,</span>
 <span class="event__item__location__place">Teatr</span>
 <p class="event__price__info">od 45 zł</p></div>
<div class="event__item"><a class="event__item__title" href="b">Fest</a>
 <div class="event__info__calendar">25 lipca - 16 sierpnia 2026</div>
 <p class="event__price__label">Wstęp wolny</p></div>
<div class="event__item"><a class="event__item__title" href="c">Kup bilety</a></div></section>
<footer><p class="event__price__info">99</p></footer></body>"""


def page_frame(spark, html, **extra):
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    return df.withColumns({k: F.lit(v) for k, v in {"base_url": "https://s.example/", **extra}.items()})


def test_table_rows(spark):
    rows = pages.html_rows(page_frame(spark, TABLE_HTML), RUN).orderBy("row_no").collect()
    got = [(r.title, r.url, r.start, r.city, r.subcategory, r.description, r.is_free) for r in rows]
    assert got == [
        ("AI evening & more", "https://s.example/wydarzenia/one", "2026-06-10", "Gdynia",
         "meetup | ML, LLM", "ML, LLM", True),
        ("Second", "https://x.example/wydarzenia/two", "2027-02-01", None, "", "", False),
    ]


def test_cards(spark):
    frame = page_frame(spark, CARD_HTML, force_category="concert")
    rows = pages.html_cards(frame, RUN).orderBy("row_no").collect()
    got = [(r.title, r.url, r.start, r.end, r.city, r.venue, r.price_min, r.is_free,
            r.force_category) for r in rows]
    assert got == [
        ("Show", "https://s.example/imprezy/a", "2026-06-07T18:00", None, "Gdańsk", "Teatr",
         "45", False, "concert"),
        ("Fest", "https://s.example/b", "2026-07-25", "2026-08-16", "Trojmiasto", "", None, True,
         "concert"),
    ]


def nested(depth):
    return "<div>" * depth + "Deep" + "</div>" * depth


def test_rows_of_any_nesting_quoting_and_case(spark):
    html = f"""<BODY><A CLASS='x clearfix' HREF='/wydarzenia/a?x=1&amp;y=2'><!-- <a> -->
      <div class='colTab title'>{nested(9)} R&oacute;&#380;a &lt;b&gt;</div><script>"</a>"</script>
      <div title='a > b' class=colTab><p class='colTab city'>Sopot</p></div><br>
      <div class="colTab type">talk</A><a class=clearfix href=/wydarzenia/b><p class="colTab title">Two</body>"""
    rows = pages.html_rows(page_frame(spark, html), RUN).orderBy("row_no").collect()
    assert [(r.title, r.url, r.city, r.subcategory) for r in rows] == [
        ("Deep Róża <b>", "https://s.example/wydarzenia/a?x=1&y=2", "Sopot", "talk"),
        ("Two", "https://s.example/wydarzenia/b", None, ""),
    ]


def test_cards_end_where_their_element_ends(spark):
    html = """<main><div class='event__item'><section><div><a class='event__item__title' href='a'>One</a></div>
      </section><nav>x</nav><footer>y</footer><p class='event__price__info'>od 45 zl</p></div>
      <p class='event__item__location__city'>Outside</p></main>"""
    frame = page_frame(spark, html, force_category="concert")
    assert [(r.title, r.price_min, r.city) for r in pages.html_cards(frame, RUN).collect()] == [
        ("One", "45", "Trojmiasto")]


def script(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return f'<script type="application/ld+json">{text}</script>'


def brute_walk(node, path=()):
    """Objects with a name and a start date, in path order, members of an object by key."""
    out = []
    if isinstance(node, dict):
        if node.get("name") and node.get("startDate"):
            out.append((node["name"], node["startDate"]))
        children = [node[k] for k in sorted(node)]
    else:
        children = node if isinstance(node, list) else []
    for child in children:
        out += brute_walk(child)
    return out


def test_walk_reaches_any_depth(spark):
    deep = {"name": "deep", "startDate": "2026-01-01"}
    for level in range(60):
        deep = {"k": [deep, level]} if level % 2 else {"z": deep, "name": "no start"}
    doc = {"@graph": [deep, {"name": "A", "startDate": "2026-06-10T19:00", "location": "online",
                             "x": [{"name": "B", "startDate": "2026-06-11"}]},
                      {"name": "A", "startDate": "2026-06-10T21:00", "url": "late"},
                      {"name": "", "startDate": "2026-06-10"}]}
    html = script("{broken") + script(doc) + script([{"name": "C", "startDate": "2026-06-12",
        "location": {"name": "Hall", "address": {"addressLocality": "Sopot"}}}])
    frame = page_frame(spark, html)
    found = jsonld.jsonld_walk(frame, ["page_id"], F.lit("Trojmiasto"))
    ordered = found.orderBy("block_no", "hit_no").collect()
    assert [(r.title, r.start) for r in ordered] == brute_walk(doc) + [("C", "2026-06-12")]
    assert [r.block_no for r in ordered][-1] == 2
    first = jsonld.listing_dedup(found, ["page_id"], ["block_no", "hit_no"])
    rows = {(r.title, r.start): (r.city, r.venue, r.url) for r in first.collect()}
    assert rows == {("deep", "2026-01-01"): ("Trojmiasto", None, None),
                    ("A", "2026-06-10T19:00"): ("Trojmiasto", None, None),
                    ("B", "2026-06-11"): ("Trojmiasto", None, None),
                    ("C", "2026-06-12"): ("Sopot", "Hall", None)}


def test_first_item_list_only(spark):
    items = {"@type": "ItemList", "itemListElement": [
        {"item": {"name": "X", "startDate": "2026-07-01", "url": "u",
                  "location": {"name": "Gdańsk , Sopot"}}},
        {"name": "Y", "location": {"name": "Hala", "address": {"addressLocality": "Kraków"}}},
        {"item": None}, {"item": {"name": ""}}, 3]}
    html = script({"@type": "Other"}) + script(items) + script(
        {"@type": "ItemList", "itemListElement": [{"name": "Z"}]})
    rows = jsonld.jsonld_itemlist(page_frame(spark, html), ["page_id"]).collect()
    assert [(r.title, r.start, r.city, r.url, r.artist, r.venue) for r in rows] == [
        ("X", "2026-07-01", "Gdańsk", "u", "X", None), ("Y", None, "Kraków", None, "Y", None)]


def test_every_parser_through_the_registry(spark):
    sources = [
        {"id": name, "name": name.upper(), "streams": ["concert"], "enabled": True,
         "parser": name, "base_url": "https://s.example", "default_city": "Sopot",
         "subcategory": "kind"}
        for name in PARSERS]
    html = {"table_rows": TABLE_HTML, "cards": CARD_HTML,
            "jsonld_walk": script({"name": "A", "startDate": "2026-06-10"}),
            "jsonld_itemlist": script({"@type": "ItemList", "itemListElement": [{"name": "Y"}]}),
            "json_events": json.dumps({"events": [{"name": "E", "date": "2023-07-03"}]}),
            "page_stub": "<p>some <b>text</b></p><script>x</script>"}
    frame = spark.createDataFrame(
        [(i, name, f"https://p.example/{name}", html[name]) for i, name in enumerate(PARSERS)],
        "page_id bigint, source string, url string, html string")
    rows = parse_pages(frame, sources, RUN).collect()
    got = {}
    for r in rows:
        got.setdefault(r.source, []).append((r.title, r.city, r.subcategory, r.needs_extraction))
    assert len({(r.source, r.page_id, tuple(r.place)) for r in rows}) == len(rows) == 8
    assert sorted(t[0] for t in got["table_rows"]) == ["AI evening & more", "Second"]
    assert sorted(t[0] for t in got["cards"]) == ["Fest", "Show"]
    assert got["jsonld_walk"] == [("A", "Sopot", "meetup", None)]
    assert got["jsonld_itemlist"] == [("Y", None, "koncert", None)]
    assert got["json_events"] == [("E", "Sopot", "kind", None)]
    assert got["page_stub"] == [("[do ekstrakcji] PAGE_STUB", None, "kind", True)]
    assert [r.description for r in rows if r.needs_extraction] == ["some text"]


def test_listing_layouts(spark, tmp_path):
    records = [{"title": "A", "price_min": 499, "is_free": True, "other": 1}, {"source": "s"}]
    (tmp_path / "a.json").write_text(json.dumps(records))
    (tmp_path / "w.json").write_text(json.dumps({"events": records}))
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, records)))
    for name, layout in (("a", "array"), ("w", "wrapped"), ("l", "lines")):
        rows = listings.read_listings(spark, str(tmp_path / f"{name}.json"), layout)
        assert rows.schema.fieldNames() == RAW_SCHEMA.fieldNames()
        got = [(r.source, r.title, r.price_min, r.is_free) for r in rows.collect()]
        assert got == [("fixture", "A", "499", True), ("s", None, None, None)]
        ordered = listings.with_arrival_order(rows).select("seq").distinct().count()
        assert ordered == 2


def test_budget(spark):
    """Brute force over one large run and many small ones."""
    import random

    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"r{i % 40}", i, rng.random() < 0.4, rng.random() < 0.3,
             rng.random() < 0.5) for i in range(600)]
    df = spark.createDataFrame(
        rows, "run string, no bigint, m boolean, e boolean, f boolean").repartition(4)
    for budget in (0, 3, 1000):
        used, want = {}, {}
        for run, no, m, e, f in rows:
            wants = m or (e and f)
            granted = wants and used.get(run, 0) < budget
            used[run] = used.get(run, 0) + granted
            want[no] = (granted, "budget_exceeded" if wants and not granted and m else None)
        got = budget_admission(df, "run", ["no"], F.col("m"), F.col("e"), F.col("f"), budget)
        assert {r.no: (r.granted, r.error) for r in got.collect()} == want


def test_files_in_order_of_name_and_unreadable_lines_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"title": "1"}\nnot json\n{"title": "2"}\n')
    (tmp_path / "b.json").write_text("".join(json.dumps({"title": str(k), "description": "x" * 300}) + "\n"
                                             for k in range(3, 60)))
    rows = listings.read_listings(spark, str(tmp_path), layout="lines", arrival=True)
    assert [r.title for r in rows.orderBy("seq").collect()] == [str(k) for k in range(1, 60)]
    bad = listings.unreadable(spark, str(tmp_path), layout="lines").collect()
    assert [(r.source.rsplit("/", 1)[1], r.n_records, r.error) for r in bad] == [("a.json", 1, "invalid_json")]


@pytest.mark.parametrize("layout", ["lines", "array", "wrapped"])
def test_a_bad_field_costs_its_value_only(spark, tmp_path, layout):
    good = ['{"title": "one", "seq": 1, "price_min": 1.10}', '{"title": "two", "is_free": "yes", "city": "G"}',
            '{"seq": "7"}', '{"title": "three", "source_streams": "x", "needs_extraction": 1}', "{}"]
    bad = ["5", "null", '{"title": "cut", "seq":'] if layout == "lines" else ["5", "null", "[1]"]
    folder = tmp_path / layout
    folder.mkdir()
    for name, texts in (("a", good), ("b", good[:1] + bad + good[1:])):
        text = "\n".join(texts) if layout == "lines" else f"[{','.join(texts)}]"
        (folder / f"{name}.json").write_text(f'{{"events": {text}}}' if layout == "wrapped" else text)
    (folder / "c.json").write_text("not json")
    if layout != "lines":
        (folder / "d.json").write_text((folder / "a.json").read_text()[:-4])
        (folder / "e.json").write_bytes(f"\ufeff{(folder / 'a.json').read_text()}".encode())
        (folder / "f.json").write_bytes((folder / "a.json").read_text().encode("utf-16"))
    rows = listings.read_listings(spark, str(folder), layout, arrival=True)
    times = 2 if layout == "lines" else 4
    want = [("one", None, None, 1.1), ("two", None, "G", None), (None,) * 4, ("three", None, None, None), (None,) * 4]
    got = rows.orderBy("seq").collect()
    assert [(r.title, r.is_free, r.city, r.price_min and float(r.price_min)) for r in got] == want * times
    assert got[0].price_min == got[-10].price_min == "1.10"
    read = listings.read_listings(spark, str(folder), layout)
    assert read.count() == read.select("is_free").count() == len(want) * times
    lost = {r.source.rsplit("/", 1)[1]: r.n_records for r in listings.unreadable(spark, str(folder), layout).collect()}
    assert lost == {"b.json": 3, "c.json": 1} | ({} if layout == "lines" else {"d.json": 1})


def test_parser_names_of_existing_lists():
    from handbill.sources.parsers import parser_name

    assert parser_name({"parser": "python_crossweb"}) == "table_rows"
    assert parser_name({"method": "firecrawl"}) == "page_stub"
    assert parser_name({"parser": "no such"}) == "no such"


@pytest.mark.parametrize("layout", ["array", "wrapped"])
def test_lists_over_several_lines(spark, tmp_path, layout):
    held = [{"source": "s", "title": "a\nb", "price_min": "1.10"}, {"source": "s", "title": "c"}]
    (tmp_path / "in.json").write_text(json.dumps(held if layout == "array" else {"events": held}, indent=2))
    got = listings.read_listings(spark, str(tmp_path), layout=layout, arrival=True).orderBy("seq").collect()
    assert [(r.title, r.price_min) for r in got] == [("a\nb", "1.10"), ("c", None)]
    assert listings.unreadable(spark, str(tmp_path), layout=layout).count() == 0


def test_rows_of_a_large_batch_of_pages_leave_in_pieces():
    import pyarrow as pa
    from pyspark.sql import types as T

    from handbill.sources import markup

    class Pages:
        schema = T.StructType([T.StructField("page_id", T.LongType())])

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run

    layout = markup.RowLayout(markup.Element("p"), {"text": markup.Cell()})
    htmls = [None if k % 7 == 0 else f"<p>{k}</p><p>{'x' * (markup.PIECE_CHARS // 5)}</p>" for k in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(htmls)], names=["page_id", "html"])
    out = list(markup.layout_rows(Pages(), layout, ["page_id"])(iter([batch])))
    assert len(out) >= 4 and max(b.num_rows for b in out) <= 12
    rows = [r for b in out for r in zip(*(c.to_pylist() for c in b.columns))]
    assert [(i, n, t[:2]) for i, n, t in rows] == [
        x for k in range(30) if k % 7 for x in ((k, 0, str(k)), (k, 1, "xx"))]
