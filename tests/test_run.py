"""Captures to the consolidated table, the way a run goes."""

import datetime as dt

from anaquel.operators.aggregates import slice_summary
from anaquel.plans.category_batch import category_batch
from anaquel.plans.extract import observations_from_pages
from anaquel.plans.usable_pages import screened_pages, usable_pages
from anaquel.schema import CAPTURE
from anaquel.session import materialise
from anaquel.sources.captures import scan_captures
from anaquel.sources.consolidated import merge_batch, scan_consolidated
from anaquel.sources.dims import dim_category, dim_location

AT = dt.datetime(2026, 8, 19, 12)


def capture(retailer, category, location, page, html, body="", status=200, url="https://x.example/c", state=""):
    return (retailer, category, location, 1, page, 1, url, status, "título", html, body, state, AT)


def walmart_card(sku, now, before=""):
    return f'<div><a href="/ip/pasta/{sku}">Pasta dental Colgate {sku}</a><span>precio actual ${now} {before}</span> Recoger</div>'


def test_run(spark, tmp_path):
    landed = [
        capture("walmart", "cuidado-bucal", "sc-toreo", 1, walmart_card("00000001", "10.00", "Antes $12.00") + walmart_card("00000002", "5.00"), "SC Toreo 11220"),
        capture("walmart", "cuidado-bucal", "sc-toreo", 2, walmart_card("00000003", "7.00"), "sin tienda"),
        capture("walmart", "cuidado-bucal", "sc-toreo", 3, walmart_card("00000004", "7.00"), "Robot or human?"),
        capture("walmart", "depilacion-y-rasurado", "sc-toreo", 1, walmart_card("00000005", "7.00"), "sin prueba"),
        capture("chedraui", "lavanderia", "chedraui-polanco", 1,
                '<section><a href="/jabon-zote-4444/p" title="Jabón Zote"></a><p class="sellingPriceValue">$20.00</p><p class="listPriceValue">$25.00</p></section>',
                "", state="Selecto Polanco 232"),
        capture("farmacias-san-pablo", "preservativos", "san-pablo-online", 1, '<div><a href="/z/p/000700142">Durex</a> $1.00</div>'),
        capture("farmacias-san-pablo", "preservativos", "san-pablo-online", 2, '<h1>Condón Durex</h1><h3 class="priceTotal">$75.00</h3><del>$100.00</del>',
                url="https://www.farmaciasanpablo.com.mx/z/p/000700142"),
        capture("farmacias-san-pablo", "preservativos", "san-pablo-online", 3, "<h1>roto</h1>", status=500, url="https://www.farmaciasanpablo.com.mx/z/p/9"),
    ]
    path = str(tmp_path / "captures")
    spark.createDataFrame(landed, CAPTURE).write.parquet(path)
    captures = scan_captures(spark, path)

    screened = {(r["retailer_id"], r["category_id"], r["page_number"]): r for r in screened_pages(captures, dim_location(spark)).collect()}
    assert screened[("walmart", "cuidado-bucal", 2)]["page_method"] == "session:category_text"
    assert screened[("walmart", "cuidado-bucal", 3)]["blocked"]
    assert screened[("walmart", "depilacion-y-rasurado", 1)]["session_status"] == "STORE_CONTEXT_ERROR"
    assert screened[("farmacias-san-pablo", "preservativos", 3)]["status"] == 500

    pages = usable_pages(captures, dim_location(spark))
    rows = materialise(observations_from_pages(pages, ["run_id", "category_id", "location_id", "page_number"]), "observations")
    table = str(tmp_path / "table")
    batch, rejected = category_batch(rows, dim_category(spark), dim_location(spark))
    merge_batch(spark, table, batch)
    got = {r["sku"]: r for r in scan_consolidated(spark, table).collect()}
    assert set(got) == {"00000001", "00000002", "00000003", "4444", "700142"}
    w, c, p = got["00000001"], got["4444"], got["700142"]
    assert (float(w["price_current"]), float(w["price_regular"]), w["brand"], w["store_id"], w["pickup_available"]) == (10.0, 12.0, "Colgate", "2344", True)
    assert (w["store_context_verified"], w["store_context_method"], w["department"]) == (True, "category_text", "Belleza y cuidado personal")
    assert w["scrape_timestamp"] == AT and w["url"] == "https://www.walmart.com.mx/ip/pasta/00000001"
    assert (c["brand"], c["store_context_method"], c["subcategory"], float(c["price_regular"])) == ("Zote", "browser_state", "Lavandería", 25.0)
    assert (p["brand"], p["promotion"], p["store_context_verified"], p["city"]) == ("Durex", "25% de descuento | Precio promocional", False, "Catálogo online")
    assert {r["products"] for r in slice_summary(scan_consolidated(spark, table)).collect()} == {3, 1}
