"""Markup and payload extraction on small fixtures."""

import gc
import json
import re
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from anaquel.functions import html
from anaquel.functions.html import html_nodes, parse_page
from anaquel.operators import drift as D
from anaquel.operators import listing_html as H
from anaquel.operators import payloads as Q
from anaquel.plans.extract import observations_from_pages


def pages(spark, retailer, *htmls):
    return spark.createDataFrame(
        [(i, retailer, f"https://x.example/p/{i}", h) for i, h in enumerate(htmls)],
        "page_id int, retailer_id string, url string, html string",
    )


def test_parser_nesting_and_broken_markup():
    text, nodes = parse_page("<div><p>a<p>b<br>c</div></span><ul><li>x<li>y</ul><script>var z='$1'</script>")
    by_tag = [(n["tag"], n["up"][1:2]) for n in nodes]
    assert by_tag == [("div", []), ("p", [0]), ("p", [0]), ("br", [2]), ("ul", []), ("li", [4]), ("li", [4]), ("script", [])]
    assert nodes[0]["last"] == 3 and "$1" not in "".join(text)
    assert parse_page(None) == ([], [])


def test_labelled_cards_climb_to_the_price(spark):
    html = """<main><section><div class=c><a href="/ip/uno/00000001" aria-label="Pasta dental uno"></a>
      <div><b>x</b></div><span>precio actual $10.00</span> <i>Antes $12.00</i> Pickup</div>
      <div class=c><a href="/ip/dos/00000002"><img alt="Cepillo dos"></a><p>agotado</p></div></section></main>
      <a href="/otra">no</a><a href='/ip/uno/00000001'>repetida</a>"""
    cards = H.extract_cards(pages(spark, "walmart", html), "walmart", ["page_id", "retailer_id"]).orderBy("position").collect()
    assert [(c["href"], c["product"]) for c in cards][0] == ("/ip/uno/00000001", "Pasta dental uno")
    assert cards[0]["text"].startswith("x") and "precio actual $10.00" in cards[0]["text"]


def test_only_the_first_link_to_an_address_counts(spark):
    html = '<a href="/ip/x/00000001">sin precio alguno</a>' + "<p>" * 11 + "<b>$5.00</b>" + "</p>" * 11
    bare = "<nav>" + "<i>" * 11 + '<a href="/ip/x/00000001">sin precio</a>' + "</i>" * 11 + "</nav>"
    card = '<div><a href="/ip/x/00000001">Pasta dental</a> precio actual $10.00</div>'
    assert H.extract_cards(pages(spark, "walmart", bare + card), "walmart", ["page_id", "retailer_id"]).count() == 0
    assert H.extract_cards(pages(spark, "walmart", card + bare), "walmart", ["page_id", "retailer_id"]).count() == 1
    assert H.extract_cards(pages(spark, "walmart", html), "walmart", ["page_id", "retailer_id"]).count() == 0


def test_tile_link_is_the_first_in_the_page(spark):
    tile = (
        '<div class="product-tile js-product-card"><div class="pdp-link"><b><a href="/a/1.html">Uno</a></b></div>'
        '<a class="product-tile--link" href="/a/2.html"></a><a href="/a/3.html" data-quickview="false">x</a></div>'
    )
    row = H.extract_cards(pages(spark, "soriana", tile), "soriana", ["page_id", "retailer_id"]).first()
    assert (row["href"], row["product"]) == ("/a/1.html", "Uno")


def test_pages_to_observations(spark):
    tile = (
        '<div class="product-tile js-product-card" data-pid="77"><a class="product-tile--link" href="/a/77.html">Pasta Colgate</a>'
        '<div class="price product-tile--price"><span class="list"><span class="value">$1,250.00</span></span><span class="sales">$999.50</span></div>'
        '<span class="product-badge"> 3x2 </span></div>'
    )
    farmacia = (
        '<div><div class="card"><div class="brandName">DUREX</div><a href="/x-1400185.html"><h3>Preservativos Zero</h3></a>'
        "<span>$179.00</span><br><span>$134.25</span><button>Agregar</button></div></div>"
    )
    rows = pages(spark, "soriana", tile).unionByName(pages(spark, "farmacias-guadalajara", farmacia))
    got = {r["retailer_id"]: r for r in observations_from_pages(rows, ["page_id"]).collect()}
    s, g = got["soriana"], got["farmacias-guadalajara"]
    assert (s["sku"], s["brand"], float(s["price_current"]), float(s["price_regular"]), s["promotion"]) == ("77", "Colgate", 999.5, 1250.0, "3x2")
    assert s["url"] == "https://www.soriana.com/a/77.html"
    assert (g["sku"], g["brand"], g["product"], float(g["price_current"]), float(g["price_regular"])) == ("1400185", "DUREX", "Preservativos Zero", 134.25, 179.0)
    assert g["promotion"] == "Precio promocional"


LD = '<script type="application/ld+json">{}</script>'


@pytest.mark.parametrize(
    "scripts, product, brand",
    [
        (['{"@type":"Product","name":" A ","brand":"B"}'], "A", "B"),
        (['{bad', '[{"@type":"Thing"},{"@type":"PRODUCT","name":"A","brand":{"name":"B"}}]'], "A", "B"),
        (['{"@graph":[{"@type":"WebPage"},{"@type":"Product","name":"A"}]}'], "A", None),
        (['{"@type":"Organization","name":"A"}'], None, None),
        (['{"@graph":[{"@graph":[[{"@type":"Product","name":"A"}]]},{"@type":"Product","name":"C"}]}'], "A", None),
        (['[[],[1,null,"x",{"@graph":{"@type":"Product"}}],{"@type":"product","name":"A","@graph":[{"@type":"Product"}]}]'], "A", None),
        (["[" * 40 + '{"@type":"Product","name":"A","brand":{"name":"B"}}' + "]" * 40], "A", "B"),
        (['{"@type":"Thing","@type":"Product","name":"A","name":"C"}'], "C", None),
        (['{"@type":["Product"],"name":"A"}', "", "[]", "null", '"Product"'], None, None),
    ],
)
def test_json_ld(spark, scripts, product, brand):
    frame = pages(spark, "farmacias-san-pablo", "".join(LD.format(s) for s in scripts))
    rows = H.extract_json_ld(frame, ["page_id"]).collect()
    assert [(r["product"], r["brand"]) for r in rows] == ([] if product is None else [(product, brand)])


def test_json_ld_is_cut_out(spark):
    """Plain scripts are not unrolled as variants; odd ones are, and both ways give the same."""
    plain = [
        '{"@graph":[[{"@type":"Thing"},{"@type":"Product","name":"A","brand":{"name":"\\ud83dB","n":[1.50,-0,1e400,true,null]},"sku":12345678901234567890123}]]}',
        '{"@type":"Product","name":1.10,"brand":[],"offers":{"price":10.0,"price":9.90},"mpn":null}',
        '{"@type":"Product","name":"A',
        "",
    ]
    odd = [
        '{"@type":"Product","name":"A"} rest', '\ufeff{"@type":"Product"}', '{"@type":"Product","name":NaN}', '["' + "x" * 50_000 + '"]',
        "[" * 1001 + "]" * 1001, '{"@type":"Product","name":' + "1" * 1001 + "}",
    ]
    later = '{"@type":"Product","name":"later"}'
    rows = spark.createDataFrame([(i, LD.format(s) + LD.format(later)) for i, s in enumerate(plain + odd)], "page_id int, html string")
    scripts = H.all_matches(F.col("html"), H.JSON_LD_SCRIPT)
    left = rows.select(H.cut_product(scripts, H.JSON_LD_FIELDS)["left"].isNotNull().alias("left"), "page_id").orderBy("page_id").collect()
    assert [r["left"] for r in left] == [False] * len(plain) + [True] * len(odd)
    got = {r["page_id"]: r["_ld"] for r in H.with_json_ld(rows, ["page_id"]).collect()}
    fields = [F.try_variant_get("v", f"$.{n}", "string").alias(n) for n in H.JSON_LD_FIELDS]
    want = rows.select("page_id", H.json_ld_product(scripts).alias("v")).select("page_id", *fields).collect()
    assert {r["page_id"]: tuple(got[r["page_id"]]) for r in want} == {r["page_id"]: tuple(r)[1:] for r in want}


def test_product_detail(spark):
    html = LD.format('{"@type":"Product","name":"Spray Afrin","gtin13":"7501234567890","offers":{"price":"10"}}') + (
        '<h3 class="priceTotal">$75.00</h3><del>$100.00</del><s>sin</s>'
    )
    bare = '<h1>Gel Lacer</h1><div data-product-code="x 123456"></div><p>Código: 999999</p>'
    rows = {r["page_id"]: r for r in H.product_details(pages(spark, "farmacias-san-pablo", html, bare), ["page_id", "url"]).collect()}
    a, b = rows[0], rows[1]
    assert (a["sku"], a["brand"], float(a["price_current"]), float(a["price_regular"])) == ("7501234567890", "Afrin", 75.0, 100.0)
    assert a["promotion"] == "25% de descuento | Precio promocional"
    assert (b["sku"], b["brand"], b["product"], b["price_current"]) == ("123456", "Lacer", "Gel Lacer", None)


def test_counters(one):
    v = F.col("v")
    assert one(H.displayed_max(v), v="(12 productos) 1 Producto, 120 PRODUCTOS") == 120
    assert one(H.displayed_first(v), v="1,284 Productos y 5 productos") == 1284
    assert one(H.total_pages(v), v='<section class="c-pagination-carousel" data-total-pages="14.0">') == 14
    assert one(H.total_pages(v), v="<section>") == 1


def payload(**items):
    return json.dumps({"catalog": {"content": [items] if items else [], "pagination": {"total": 1}}})


def test_search_items(spark):
    good = {"sku": "7896009419324", "ecommTitle": "Crema Dental Sensodyne Original 90 g", "ecommBrand": "SENSODYNE",
            "ecommUrlKey": "crema-dental-sensodyne-original-90-g", "currentPrice": 79.0, "previousPrice": 90.0}
    plain = {"sku": "123", "ecommTitle": "Producto", "ecommBrand": "Marca", "ecommUrlKey": "producto", "currentPrice": 100, "previousPrice": None}
    frame = spark.createDataFrame(
        [(1, payload(**good)), (2, payload(**plain)), (3, payload(**{**plain, "sku": " "})), (4, payload()), (5, "{}")],
        "page int, payload string",
    )
    items = Q.scan_search_payloads(frame, ["page"])
    assert items.count() == 5
    rows = {r["page"]: r for r in Q.map_search_items(items, ["page"]).collect()}
    assert set(rows) == {1, 2}
    assert (float(rows[1]["price_current"]), float(rows[1]["price_regular"]), rows[1]["promotion"]) == (79.0, 90.0, "12% de descuento | Precio promocional")
    assert rows[1]["url"].endswith("/crema-dental-sensodyne-original-90-g.html")
    assert rows[1]["store_context_method"] == "online_catalog_empathy_nacional"
    assert (float(rows[2]["price_regular"]), rows[2]["promotion"]) == (100.0, None)


def test_product_search(spark):
    offer = {"Price": 50, "ListPrice": 74, "AvailableQuantity": 10, "discountHighlights": [], "teasers": []}
    product = {"productId": "3908355", "productName": "Suavizante Suavitel Primavera 500ml", "brand": "Suavitel",
               "link": "/suavizante-suavitel-primavera-500ml-3908355/p", "items": [{"sellers": [{"sellerDefault": True, "commertialOffer": offer}]}]}
    ranged = {**product, "productId": "", "productReference": "R1", "items": [], "priceRange": {"sellingPrice": {"lowPrice": 9}, "listPrice": {"lowPrice": 8}}}
    unpriced = {**product, "productId": "2", "items": []}
    body = {"data": {"productSearch": {"recordsFiltered": 382, "products": [product, ranged, unpriced]}}}
    frame = spark.createDataFrame([(1, json.dumps(body)), (2, "{}")], "page int, payload string")
    rows = {r["sku"]: r for r in Q.map_product_search(Q.scan_product_search(frame, ["page"]), ["page"]).collect()}
    assert set(rows) == {"3908355", "R1"}
    a, b = rows["3908355"], rows["R1"]
    assert (a["records_filtered"], a["brand"], float(a["price_current"]), float(a["price_regular"])) == (382, "Suavitel", 50.0, 74.0)
    assert a["store_context_verified"] and "productSearchV3" in a["store_context_method"] and a["pickup_available"]
    assert (float(b["price_current"]), float(b["price_regular"]), b["promotion"]) == (8.0, 9.0, "Precio promocional")


def test_payload_fields_and_drift(spark):
    texts = ['{"a":{"b":[{"c":1},{"c":"x","d":[]}]},"e":true}', "{bad", "[[1.5,null]]", None, '{"a":1,"a":{"b":[]}}']
    pages_ = spark.createDataFrame([(k // 2, k, t) for k, t in enumerate(texts)], "run int, page int, payload string")
    rows = {}
    for r in D.payload_fields(pages_, ["page"]).collect():
        rows.setdefault(r["page"], set()).add((r["path"], r["kind"]))
    assert rows == {
        0: {("a.b[].c", "number"), ("a.b[].c", "text"), ("a.b[].d", "nothing"), ("e", "boolean")},
        1: {(None, None)}, 2: {("[][]", "number"), ("[][]", "nothing")}, 3: {(None, None)}, 4: {("a.b", "nothing")},
    }
    found = D.payload_drift(pages_, ["run"], {"a.b[].c": "number", "e": "text", "f": "text"}).collect()
    assert {tuple(r) for r in found} == {
        (0, None, None, "broken", 1), (0, "a.b[].c", "text", "kind", 1), (0, "a.b[].d", "nothing", "unknown", 1),
        (0, "e", "boolean", "kind", 1), (0, "f", None, "missing", 1),
        (1, None, None, "broken", 1), (1, "[][]", "number", "unknown", 1), (1, "[][]", "nothing", "unknown", 1),
        (1, "a.b[].c", None, "missing", 1), (1, "e", None, "missing", 1), (1, "f", None, "missing", 1),
        (2, "a.b", "nothing", "unknown", 1), (2, "a.b[].c", None, "missing", 1), (2, "e", None, "missing", 1),
        (2, "f", None, "missing", 1),
    }


def test_payloads_of_one_shape_share_one_parse(spark):
    same = ['{"a b":"x","n":[1,-2.5e3]}', '{"a b":"\\"y:\\u00e9","n":[70,0]}', '{"a b":"","n":[12345,0.001]}']
    odd = [
        '{"k1":"v:","k1":2 , "k2" : "a"}', '"x"', "5", "-", "[01]", "[1.]", "[.5]", "[1,2", '{"a":"b}', '["\\x"]', '["\\ud800"]', "[tru1]", "[--1]", "[1 2]",
        '{"a"::"b"}', '["a" "b"]', "[1e5,1E-2,1e999]", "[123456789012345678901234567890]", '{"1":"2","-3":-4}', "", None, '{"a":"line\nbreak"}', '{"a{":1},{"',
    ]
    frame = spark.createDataFrame(list(enumerate(same + odd)), "page int, payload string")
    shaped = frame.select("page", D.payload_shape(frame["payload"]).alias("payload")).localCheckpoint()
    assert shaped.where("page < 3").select("payload").distinct().count() == 1
    assert shaped.where("page = 3").first()["payload"] == '{"k1":"","k1":0 , "k2" : ""}'
    fields = lambda f: {tuple(r) for r in D.payload_fields(f, ["page"]).collect()}
    assert fields(frame) == fields(shaped)


def test_read_payloads_keeps_every_row(spark):
    texts = [
        '{"items":[{"sku":7,"price":"1.50"},{"sku":"8","cost":{"now":2}},{"sku":"9","price":"n/d"},{"price":1},5]}',
        '{"list":[{"sku":{"id":1},"price":3},{"sku":"s","price":null,"cost":{"now":4}}]}', '{"items":[]}', '{"x":1}', "{bad", None,
    ]
    rule = D.PayloadRule(("$.items", "$.list"), {"sku": ("$.sku",), "price": ("$.price", "$.cost.now")}, {"price": "decimal(12,2)"}, ("sku",))
    rows = D.read_payloads(spark.createDataFrame(list(enumerate(texts)), "page int, payload string"), ["page"], rule).collect()
    got = {(r["page"], r["position"]): (r["sku"], None if r["price"] is None else float(r["price"]), r["reject_reason"]) for r in rows}
    assert got == {
        (0, 0): ("7", 1.5, None), (0, 1): ("8", 2.0, None), (0, 2): ("9", None, "unfit price"),
        (0, 3): (None, 1.0, "missing sku"), (0, 4): (None, None, "missing sku"),
        (1, 0): (None, 3.0, "unfit sku"), (1, 1): ("s", 4.0, None),
        (2, None): (None, None, "no items"), (3, None): (None, None, "no items"),
        (4, None): (None, None, "broken payload"), (5, None): (None, None, "broken payload"),
    }
    assert {r["page"]: r["raw"] for r in rows if r["position"] is None} == {2: '{"items":[]}', 3: '{"x":1}', 4: "{bad", 5: None}


def test_details_hand_over_only_nodes_that_their_rules_read(spark):
    html = (
        "<div><p>x</p><h1>Uno</h1><b class='big name'>Dos</b><meta itemprop='sku' content='123456'><s>$5.00</s>"
        "<h3 class='priceTotal'>$3.00</h3><h3>otro</h3><i data-sku='7'></i></div>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>nada</p>")], "id int, html string")
    whole = {r["id"]: r for r in html_nodes(pages, ["id"]).collect()}
    found = {r["id"]: r for r in html_nodes(pages, ["id"], 1, H.DETAIL_NODES).collect()}
    assert [n["tag"] for n in found[1]["nodes"]] == ["h1", "b", "meta", "s", "h3", "i"]
    assert [found[k]["nodes"] for k in (2, 3)] == [[], []]
    for n in found[1]["nodes"]:
        same = whole[1]["nodes"][n["pos"]]
        assert {k: v for k, v in n.asDict().items() if k != "up"} == {k: v for k, v in same.asDict().items() if k != "up"}
    assert [r["pieces"] for r in found.values()] == [whole[k]["pieces"] for k in found]


def test_texts_of_nodes_keep_their_white_space_rules(spark):
    spaces = ["", " ", "  ", "\t", " \n", "\n ", "\xa0", "\x85", "\u2028", " \u2028", "\u2003\u3000", "\x1c", "\x1e", " \x1e ", "\x1e\n\x1e"]
    raw = [(a + "x" + b + "é" + c,) for a in spaces for b in spaces for c in spaces] + [(a + b,) for a in spaces for b in spaces]
    clean = F.replace("t", F.lit("\x1e"), F.lit(""))
    lines = F.regexp_replace("t", "[ \\t]*(?:\x1e\\s*)+", "\n")
    same = spark.createDataFrame(raw, "t string").select(
        (H._flat(F.col("t")) == F.trim(F.regexp_replace(clean, r"(?U)\s+", " "))).alias("flat"),
        (H._loose(F.col("t")) == F.regexp_replace(clean, r"(?U)^\s+|\s+$", "")).alias("loose"),
        (H._shown(F.col("t")) == F.trim(F.regexp_replace(lines, r"^\s+|\s+$", ""))).alias("shown"),
    )
    assert same.where("not (flat and loose and shown)").count() == 0


def test_nodes_without_a_money_sign_are_not_read(spark):
    """Judging a node whose text holds no sign of money must not squeeze or search its text."""
    for rule in ("walmart", "chedraui", "farmacias-guadalajara"):
        node = spark.sql("select array('a') as pieces, array(struct(0 as start, 1 as stop)) as nodes")
        plan = node.select(H.CARD_RULES[rule].judged(H.CARD_RULES[rule]).alias("fits"))._jdf.queryExecution().analyzed().toString().lower()
        assert plan.index("contains(") < plan.index("regexp_replace(")


def test_plain_tags_are_read_as_the_library_reads_them(monkeypatch):
    bits = ['<div>', '<div class="a b">', '</div>', '<a href="/x?a=1">', '<a href="/x?a&amp;b">', '</a>', "<A HREF=x>", "<script>",
            "</script>", "<title>", "</title>", "<br/>", '<img alt="">', "$1 &amp; 2", "&am", "<", ">", '"', "<!--", "-->", "</ div>",
            "</div x>", '<li data-x="1>2">', "<b\n>", '<i  class="q">', '<a b="1"c="2">', "</", "<d", '<p class="">', "<plaintext>"]
    draw = Random(7)
    pages = ["".join(draw.choices(bits, k=9)) for _ in range(3000)]
    read = [parse_page(p, 3) for p in pages]
    never = re.compile(r"(?!)")
    assert any(html.PLAIN_START.search(p) for p in pages)
    monkeypatch.setattr(html, "PLAIN_START", never)
    monkeypatch.setattr(html, "PLAIN_END", never)
    assert read == [parse_page(p, 3) for p in pages]


def test_collector_rests_while_pages_are_parsed(monkeypatch):
    seen, whole = [], html.parse_page
    monkeypatch.setattr(html, "parse_page", lambda *a: (seen.append(gc.isenabled()), whole(*a))[1])
    monkeypatch.setattr(html, "CHUNK", 5)
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4], "html": ["<p>a</p>", None, "<b>", "x"]})
    out = list(html._parser(3, None)([batch, batch.slice(4)]))
    assert seen == [False] * 4 and gc.isenabled()
    assert [b.column("k").to_pylist() for b in out] == [[1], [2, 3, 4]] and out[0].column("pieces").to_pylist() == [["\x1e", "a", "\x1e"]]
