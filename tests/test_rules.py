"""Single values through the column rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions import brands as B
from anaquel.functions import classify as C
from anaquel.functions import money as M
from anaquel.functions import promotions as P
from anaquel.functions import text as X
from anaquel.functions import urls as U
from anaquel.operators import listing_html as H
from anaquel.operators.prices import extract_promotions, resolve_prices
from anaquel.operators.screening import classify_blocks, verify_stores

V = F.col("v")


@pytest.mark.parametrize(
    "value, expected",
    [("$1,234.50", "1234.50"), ("$24.50", "24.50"), (None, None), ("sin precio", None), ("-3.129 x", "-3.12"), ("", None)],
)
def test_parse_money(one, value, expected):
    assert one(M.parse_money(V), v=value) == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize("value, expected", [("79.0", "79.00"), ("100", "100.00"), ("n/d", None), (None, None)])
def test_to_price(one, value, expected):
    assert one(M.to_price(V), v=value) == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    "value, expected",
    [("  a \t b  c\n", "a b c"), ("\x1c \x1f", None), ("", None), (None, None)],
)
def test_clean_text(one, value, expected):
    assert one(X.clean_text(V), v=value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("Mantén  PRESIONADO Ñandú Ü", "manten presionado ñandu u"), (None, "")],
)
def test_fold_accents(one, value, expected):
    assert one(X.fold_accents(V), v=value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("SC%20Toreo+x", "sc toreo+x"), ("100%zz caf%C3%A9", "100%zz cafe"), ("%", "%")],
)
def test_fold_decoded(one, value, expected):
    assert one(X.fold_decoded(V), v=value) == expected


@pytest.mark.parametrize(
    "url, pid, expected",
    [
        ("https://www.soriana.com/algo/371875.html", None, "371875"),
        ("https://www.chedraui.com.mx/Enjuague-Bucal-Colgate-Total-12-Anti-Sarro-500ml-3646798/p", None, "3646798"),
        ("https://www.soriana.com/algo/371875.html", "ABC123", "ABC123"),
        ("https://www.walmart.com.mx/ip/pasta-dental-colgate/00750954607184", None, "00750954607184"),
        ("https://www.soriana.com/algo/371875.html", "  ", None),
        ("https://x.example/a/1234567", None, None),
        ("https://x.example/a/123456789;v=1?q=/2.html", None, "123456789"),
        (None, None, None),
    ],
)
def test_sku_from_url(one, url, pid, expected):
    assert one(U.sku_from_url(F.col("u"), F.col("p")), u=url, p=pid) == expected


def test_sku_rules(one):
    url = "https://www.farmaciasguadalajara.com/preservativos/preservativos-lubricados-prudence-zero--10-pzas.-1400185.html"
    assert one(U.sku_dash_html(V), v=url) == "1400185"
    assert one(U.sku_p_path(V), v="https://x.example/sterimar-nasal/p/000000000000700142") == "700142"
    assert one(U.sku_p_path(V), v="https://x.example/p/0000?x=1") == "0000"
    markup = '<div class="product attribute sku"><div class="value" itemprop="sku">7509546000343</div></div>'
    assert one(U.sku_html(V), v=markup) == "7509546000343"


@pytest.mark.parametrize(
    "href, expected",
    [
        ("/producto/123.html", "https://www.soriana.com/producto/123.html"),
        ("https://a.example/x", "https://a.example/x"),
        ("//a.example/x", "https://a.example/x"),
        ("../x.html", "https://www.soriana.com/x.html"),
        ("x.html", "https://www.soriana.com/x.html"),
        ("", None),
        (None, None),
    ],
)
def test_absolute_url(one, href, expected):
    assert one(U.absolute_url(V, R.BY_ID["soriana"].base_url), v=href) == expected


@pytest.mark.parametrize(
    "url, page, parameter, expected",
    [
        ("https://a.example/c", 1, "page", "https://a.example/c"),
        ("https://a.example/c", 2, "page", "https://a.example/c?page=2"),
        ("https://a.example/c?facet=x", 1, "page", "https://a.example/c?facet=x"),
        ("https://a.example/c?page=7&facet=x#top", 1, "page", "https://a.example/c?facet=x#top"),
        ("https://a.example/c?page=7&facet=x", 3, "page", "https://a.example/c?page=3&facet=x"),
        ("https://a.example/c?a=1&b=2&a=3", 2, "page", "https://a.example/c?a=3&b=2&page=2"),
        ("https://a.example/c?a=x%20y&e=", 2, "page", "https://a.example/c?a=x+y&e=&page=2"),
        ("https://a.example/c.html", 2, "p", "https://a.example/c.html?p=2"),
        ("https://a.example/c.html", 1, "p", "https://a.example/c.html"),
        ("https://a.example/c", 3, "currentPage", "https://a.example/c?currentPage=3"),
        ("https://a.example/c?foo=bar", 2, "currentPage", "https://a.example/c?foo=bar&currentPage=2"),
        ("https://a.example/c?f=1&g=2&f=3", 2, "currentPage", "https://a.example/c?f=1&f=3&g=2&currentPage=2"),
    ],
)
def test_page_url(one, url, page, parameter, expected):
    assert one(U.page_url(V, F.col("n"), parameter), v=url, n=page) == expected


def test_browse_url(one):
    out = one(U.browse_url(V, F.lit(50), F.lit(50)), v="8196")
    assert out.endswith("&browseField=categoryIds&browseValue=8196") and "start=50&rows=50" in out


def prices(spark, rule, **columns):
    schema = ", ".join(
        f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in columns.items()
    )
    row = resolve_prices(spark.createDataFrame([tuple(columns.values())], schema), rule).first()
    return tuple(None if v is None else float(v) for v in (row["price_current"], row["price_regular"]))


@pytest.mark.parametrize(
    "rule, columns, expected",
    [
        ("first_last", {"text": "PRUDENCE\nPreservativos Zero\n$179.00\n$134.25\nAgregar"}, (134.25, 179.0)),
        ("first_last", {"text": "COLGATE\nPasta dental\n$65.00\nAgregar"}, (65.0, 65.0)),
        ("first_last", {"text": "$0.00"}, (None, None)),
        (
            "card",
            {"final_text": "MXN $67.50", "old_text": "MXN $90.00", "text": "25% de descuento Precio habitual MXN $90.00 Precio especial MXN $67.50"},
            (67.5, 90.0),
        ),
        ("card", {"final_text": "MXN $68.00", "old_text": None, "text": "Precio habitual MXN $68.00 MXN $68.00"}, (68.0, 68.0)),
        ("min_max", {"text": "$319.00 $223.00 30% de descuento"}, (223.0, 319.0)),
        ("min_max", {"text": "$248.00"}, (248.0, 248.0)),
        ("listed", {"price_texts": ["$20.00", "$20.00 $15.00"]}, (15.0, 20.0)),
        ("listed", {"price_texts": ["$0.00", "$5.00"]}, (0.0, 5.0)),
        ("listed", {"price_texts": ["$5.00", "$0.00"]}, (5.0, 0.0)),
        ("labelled", {"text": "precio actual MXN $10.00 Antes $8.00"}, (10.0, 8.0)),
        ("labelled", {"text": "Antes $0 $7.00 $9.00"}, (0.0, 7.0)),
        ("selected", {"selling": None, "regular": None, "price_texts": [], "text": "$9.00 $4.00"}, (4.0, 9.0)),
        ("selected", {"selling": "$3.00", "regular": None, "price_texts": ["$4.00"], "text": "$9.00"}, (3.0, 3.0)),
        ("detail", {"price_text": "$50.00", "old_texts": ["$80.00", "no"], "offer_price": "1"}, (50.0, 80.0)),
        ("detail", {"price_text": None, "old_texts": ["$80.00"], "offer_price": "12.5"}, (12.5, 12.5)),
        ("previous", {"current_price": "79.0", "previous_price": "90.0"}, (79.0, 90.0)),
        ("previous", {"current_price": "100", "previous_price": None}, (100.0, 100.0)),
        ("previous", {"current_price": "100", "previous_price": "60"}, (100.0, 100.0)),
    ],
)
def test_price_rules(spark, rule, columns, expected):
    assert prices(spark, rule, **columns) == expected


@pytest.mark.parametrize(
    "rule, text, current, regular, expected",
    [
        ("multibuy", "a $179.00 $134.25", 134.25, 179.0, "Precio promocional"),
        ("multibuy", "a $65.00", 65.0, 65.0, None),
        ("multibuy", "3 x 2 y 2x$ 50", 1.0, 2.0, "3 x 2 | 2x$ 50 | Precio promocional"),
        ("percent_text", "25% de descuento", 67.5, 90.0, "25% de descuento | Precio promocional"),
        ("percent_text", "30 %  descuento", 3.0, 3.0, "30% de descuento"),
        ("computed", "", 79.0, 90.0, "12% de descuento | Precio promocional"),
        ("computed", "", 87.5, 100.0, "12% de descuento | Precio promocional"),
        ("computed", "", 99.99, 100.0, "Precio promocional"),
        ("computed_keep_zero", "", 99.99, 100.0, "0% de descuento | Precio promocional"),
        ("computed", "", 100.0, 100.0, None),
        ("shelf_labels", "REBAJA hoy, Ahorra $5.00 rebaja", 1.0, 1.0, "REBAJA | Ahorra $5.00"),
    ],
)
def test_promotions(spark, rule, text, current, regular, expected):
    frame = spark.createDataFrame([(text, current, regular)], "text string, price_current double, price_regular double")
    assert extract_promotions(frame, rule).first()["promotion"] == expected


def test_badges_and_offer_labels(spark, one):
    frame = spark.createDataFrame([([" 3x2 ", "", "Nuevo", "3x2"],)], "promo_texts array<string>")
    assert extract_promotions(frame, "badges").first()["promotion"] == "3x2 | Nuevo"
    named = spark.sql("select array(named_struct('name', 'A'), named_struct('name', '')) as h, array(named_struct('name', 'B'), named_struct('name', 'A')) as t")
    price = F.lit(1), F.lit(2)
    assert named.select(P.offer_labels(F.col("h"), F.col("t"), *price)).first()[0] == "A | B"
    assert one(P.offer_labels(F.lit(None).cast("array<struct<name:string>>"), F.lit(None).cast("array<struct<name:string>>"), *price), v="") == R.PROMOTIONAL


@pytest.mark.parametrize(
    "retailer, product, expected",
    [
        ("chedraui", "Detergente Ace Líquido 2 L", "Ace"),
        ("chedraui", "Portacepillo Dental CoolxShock", None),
        ("chedraui", "Gel Dental Fluoxytil Lacer Fresa 75ml", None),
        ("chedraui", "SUAVIZANTE ENSUEÑO MAX", "Ensueño"),
        ("chedraui", "Limpiador Mas Color Roma", "Mas Color"),
        ("farmacias-del-ahorro", "Crema Dental Colgate Total", "Colgate"),
        ("farmacias-del-ahorro", "Portacolgate Dental", None),
        ("farmacias-san-pablo", "Sterimar Nasal 100 ml", "Stérimar"),
        ("farmacias-san-pablo", "Pasta Dental Colgate Total", "Colgate"),
        ("farmacias-san-pablo", "Portacolgate dental", None),
        ("walmart", "Mascarilla facial", "MAS"),
        ("soriana", "pasta COLGATE", "Colgate"),
    ],
)
def test_brands(one, retailer, product, expected):
    assert one(B.infer_brand(R.BY_ID[retailer], V), v=product) == expected


def test_brand_from_card_text(one):
    rule = B.infer_brand(R.BY_ID["farmacias-guadalajara"], F.col("p"), F.col("t"))
    assert one(rule, p="Detergente Ace Líquido", t="Detergente Ace Líquido") == "Ace"
    assert one(rule, p="Portacepillo Dental", t="Portacepillo Dental") is None
    assert one(rule, p="Cepillo", t="ORAL-B\nCepillo\n$10") == "Oral-B"
    assert one(rule, p="Cepillo", t="GUM\nCepillo\n$10") == "GUM"
    assert one(rule, p="Cepillo", t="Oferta\nCepillo\nTabcin") == "Tabcin"


def test_category_key(one):
    html = '{"component":"Infinite_EmpathySearch/js/view/search-list-component",\n "u":"x",\n "categoryId":"8196"} {"categoryId":"1"}'
    assert one(H.category_key(V), v=html) == "8196"
    assert one(H.category_key(V), v='{"categoryId":5} {"categoryId":"6"}') == "6"
    assert one(H.category_key(V), v="<p>") is None


@pytest.mark.parametrize(
    "retailer, status, title, body, html, expected",
    [
        ("farmacias-san-pablo", 403, "Access Denied", "", "", True),
        ("farmacias-san-pablo", 200, "", "You don't have permission to access this server", "", True),
        ("farmacias-san-pablo", 200, "Farmacias San Pablo", "Catálogo de productos", "", False),
        ("farmacias-del-ahorro", 200, "", "", '<script src="Magento_Captcha/js/captcha.js"></script><h1>Cremas</h1>', False),
        ("farmacias-del-ahorro", 200, "", "", "<html><body>Verify you  are human. Press and hold.</body></html>", True),
        ("walmart", 200, "", "MANT%C3%89N presionado", "", True),
        ("soriana", None, None, None, None, False),
    ],
)
def test_blocks(spark, retailer, status, title, body, html, expected):
    frame = spark.createDataFrame(
        [(retailer, status, "https://x.example", title, body, html)],
        "retailer_id string, status int, url string, title string, body_text string, html string",
    )
    assert classify_blocks(frame).first()["blocked"] is expected


@pytest.mark.parametrize(
    "code, text, expected",
    [
        (0, "Productos únicos: 10", "SUCCESS"),
        (0, "BLOCKED: x", "SUCCESS"),
        (2, "BLOCKED: sesión", "BLOCKED"),
        (4, "STORE_CONTEXT_ERROR: SC Toreo", "STORE_CONTEXT_ERROR"),
        (3, "No se encontraron productos", "EMPTY"),
        (3, "NETWORK_UNAVAILABLE: x", "NETWORK_UNAVAILABLE"),
        (1, "unexpected", "ERROR"),
    ],
)
def test_classify_case(one, code, text, expected):
    assert one(C.classify_case(F.col("c"), V), c=code, v=text) == expected


TOREO = ("walmart", "SC Toreo", "11220", "2344")
POLANCO = ("chedraui", "Chedraui Selecto México Polanco", "11500", "232")


@pytest.mark.parametrize(
    "store, text, state, expected",
    [
        (TOREO, "Walmart SC TOREO Blvd Manuel Avila Camacho 641 Miguel Hidalgo, CMX 11220", "", "category_text"),
        (TOREO, "Pickup sin costo, hoy en SC TOREO. Envío a Miguel Hidalgo.", "", "category_text"),
        (TOREO, "Pickup sin costo hoy. Envío, llega hoy.", "", None),
        (TOREO, "", '{"pickupStore":{"id":"2344","name":"SC Toreo"},"postalCode":"11220"}', "browser_state"),
        (TOREO, "", '{"postalCode":"11220"}', None),
        (TOREO, "pickup" + " " * 3 + "x" * 101 + "sc toreo", "", None),
        (TOREO, "sc toreo" + "x" * 100 + "pickup", "", "category_text"),
        (TOREO, "sc toreo" + "x" * 101 + "pickup", "", None),
        (TOREO, "recog" + "x" * 101 + "sc toreo y sc toreo" + "x" * 99 + "recog", "", "category_text"),
        (("walmart", "Pickup Toreo", "", ""), "pickup toreo, pickup toreo", "", "category_text"),
        (("walmart", "Pickup Toreo", "", ""), "hoy pickup toreo", "", None),
        (("walmart", "kup (To.reo)", "", ""), "kup (to.reo) pickup (to.reo)", "", "category_text"),
        (POLANCO, "Recoger en Chedraui Selecto México Polanco 11500", "", "page_text"),
        (POLANCO, "", '{"storeName":"Selecto Polanco","storeId":"232"}', "browser_state"),
        (POLANCO, "Recoger en Chedraui Selecto México Santa Fe 01219", "", None),
    ],
)
def test_store_evidence(spark, store, text, state, expected):
    frame = spark.createDataFrame(
        [(*store, text, state)],
        "retailer_id string, store string, postal_code string, store_id string, body_text string, state_blob string",
    )
    row = verify_stores(frame).first()
    assert (row["store_context_method"], row["store_context_verified"]) == (expected, expected is not None)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_url_path_is_read_once(spark):
    links = ["/a/123.html", "https://x.mx/b-4567/p?q=1", "/c/00012345;s=1", "/d", None]
    frame = spark.createDataFrame([(x,) for x in links], "url string")
    found = frame.select(U.sku_from_url(F.col("url")).alias("sku"))
    assert [r["sku"] for r in found.collect()] == ["123", "4567", "00012345", None, None]
    assert plan_of(found).count("[^?#]*)") == 1


def test_amounts_are_matched_once(spark):
    frame = spark.createDataFrame([("$1,234.567 y $ 5",), ("$,",), ("nada",), (None,)], "t string")
    found = frame.select(M.dollar_tokens(F.col("t")).alias("all"), F.when(F.col("t") != "x", M.parse_money(F.col("t"))).alias("one"))
    rows = [([float(v) for v in r["all"]], None if r["one"] is None else float(r["one"])) for r in found.collect()]
    assert rows == [([1234.56, 5.0], 1234.56), ([], None), ([], None), ([], None)]
    assert plan_of(found).count("-?[0-9]+") == 2
