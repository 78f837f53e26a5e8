"""Extraction from HTML captures: anchors, product cards, structured data, detail pages, counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel import registry as R
from anaquel.functions.brands import infer_brand
from anaquel.functions.html import BOUNDARY, LEVELS, Wanted, html_nodes
from anaquel.functions.promotions import percent_computed
from anaquel.functions.structured import cut_product
from anaquel.functions.text import all_matches, blank_to_null, bound, clean_text, first_match, once
from anaquel.functions.urls import absolute_url, sku_detail
from anaquel.functions.variants import listed, occurrences, repeated_keys, unrolled
from anaquel.operators.prices import resolve_prices
from anaquel.operators.shape import product_link
from anaquel.session import bound_batches

# Fixed value: wording that marks a pickup offer near a link.
PICKUP_WORDS = r"(?i)pickup|recoge|recoger|recogida"

ANCHOR = r"(?is)(<a\b[^>]*>.*?</a>)"
HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
LINK_HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
JSON_LD_SCRIPT = r"""(?is)<script[^>]*\btype\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""


def extract_anchors(captures: DataFrame, keys: list[str]) -> DataFrame:
    """Links of a page in order, by pattern alone."""
    anchors = captures.select(*keys, F.posexplode(all_matches(F.col("html"), ANCHOR)).alias("position", "_a"))
    inner = F.regexp_replace(F.regexp_replace("_a", r"(?s)<[^>]*>", " "), "&amp;", "&")
    return anchors.select(
        *keys,
        "position",
        first_match(F.col("_a"), HREF).alias("href"),
        clean_text(inner).alias("text"),
        first_match(F.col("_a"), r"""(?is)^<a\b[^>]*?\baria-label\s*=\s*["']([^"']*)["']""").alias("aria_label"),
        first_match(F.col("_a"), r"""(?is)^<a\b[^>]*?\btitle\s*=\s*["']([^"']*)["']""").alias("title"),
    )


def count_product_links(captures: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct product links of each page; counted inside the row, so nothing is shuffled."""
    hrefs = F.array_distinct(all_matches(F.col("html"), LINK_HREF))
    linked = F.filter(hrefs, lambda h: product_link(F.col("retailer_id"), h))
    return captures.select(*keys, F.size(linked).alias("product_links"))


def displayed_max(text: Column) -> Column:
    shown = all_matches(text, R.PRODUCTS_SHOWN)
    return F.array_max(F.transform(shown, lambda m: F.regexp_replace(m, "[,.]", "").try_cast("int")))


def displayed_first(text: Column) -> Column:
    return F.replace(first_match(text, R.PRODUCTS_FIRST), F.lit(","), F.lit("")).try_cast("int")


def total_pages(html: Column) -> Column:
    number = first_match(html, R.TOTAL_PAGES).try_cast("double").cast("int")
    return F.greatest(F.lit(1), F.coalesce(number, F.lit(1)))


def category_key(html: Column) -> Column:
    """Category id of the search component, else the last one in the page."""
    return F.coalesce(
        first_match(html, R.CATEGORY_KEY_COMPONENT),
        F.try_element_at(all_matches(html, R.CATEGORY_KEY_ANY), F.lit(-1)),
    )


# Structured data.
def json_ld_entries(script: Column) -> Column:
    """Variants of all entries of a structured-data script in document order; none if it is no JSON.

    Lists in lists and ``@graph`` in ``@graph`` are looked into at any depth; each is a layer with a bracket of its own.
    """

    def unread(v: Column) -> Column:
        return F.struct(v.alias("v"), F.lit(False).alias("read"))

    def unroll(e: Column) -> Column:
        graph = F.transform(listed(e["v"], "$['@graph']"), unread)
        entry = F.concat(F.array(F.struct(e["v"].alias("v"), F.lit(True).alias("read"))), F.coalesce(graph, F.array()))
        return F.coalesce(F.transform(listed(e["v"]), unread), entry)

    entries = unrolled(unread(F.try_parse_json(script)), occurrences(script, "["), unroll)
    return F.filter(F.transform(entries, lambda e: e["v"]), lambda v: v.isNotNull())


JSON_LD_FIELDS = ["name", "brand", "offers", *R.SKU_JSON_LD_KEYS]


def json_ld_product(scripts: Column) -> Column:
    """Variant of the first product among structured-data scripts; lists and ``@graph`` are looked into at any depth."""

    def product(v: Column) -> Column:
        return F.lower(F.try_variant_get(v, "$['@type']", "string")) == "product"

    return F.get(F.filter(F.flatten(F.transform(scripts, json_ld_entries)), product), F.lit(0))


def with_json_ld(captures: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_ld``, the fields of the first product in a page's structured data; null without one.

    Where an object repeats a key, the last one counts (:func:`anaquel.functions.variants.repeated_keys`). Pages with a
    script that the helper is not sure of are unrolled as variants.
    """
    repeated_keys(captures.sparkSession)
    bound_batches(captures.sparkSession)
    cut = captures.select(*keys, cut_product(all_matches(F.col("html"), JSON_LD_SCRIPT), JSON_LD_FIELDS).alias("_cut"))
    product, left = F.col("_cut.product"), F.col("_cut.left").cast("array<string>")
    found = F.when(product.isNotNull(), F.try_parse_json(product)).when(left.isNotNull(), json_ld_product(left))
    fields = lambda v: F.struct(*[F.try_variant_get(v, f"$.{n}", "string").alias(n) for n in JSON_LD_FIELDS])
    return cut.select(*keys, once(bound(found, lambda v: F.when(v.isNotNull(), fields(v)))).alias("_ld"))


def json_ld_brand(ld: Column) -> Column:
    """Brand as text, or as the name of a brand object."""
    is_object = F.startswith(ld["brand"], F.lit("{"))
    return clean_text(F.when(is_object, F.get_json_object(ld["brand"], "$.name")).otherwise(ld["brand"]))


def extract_json_ld(captures: DataFrame, keys: list[str]) -> DataFrame:
    ld = F.col("_ld")
    return (
        with_json_ld(captures, keys)
        .where(ld.isNotNull())
        .select(
            *keys,
            clean_text(ld["name"]).alias("product"),
            json_ld_brand(ld).alias("brand"),
            F.coalesce(*[ld[k] for k in R.SKU_JSON_LD_KEYS]).alias("sku"),
            F.get_json_object(ld["offers"], "$.price").alias("offer_price"),
        )
    )


# Node arrays.
def _raw(n: Column) -> Column:
    return F.array_join(F.slice("pieces", n["start"] + 1, n["stop"] - n["start"]), "")


def page_text() -> Column:
    return F.array_join("pieces", "")


# A run of white space other than a single space, which is as it should be: most spaces of a long text are.
UNEVEN_SPACE = r"(?U)\s(?:(?<! )|(?=\s))\s*"
SPACES = " \t\n\x0b\f\r"
UNICODE_SPACES = SPACES + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _flat(raw: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(raw, F.lit(BOUNDARY), F.lit("")), UNEVEN_SPACE, " "))


def flat_text(n: Column) -> Column:
    """All text of a node on one line."""
    return _flat(_raw(n))


def loose_text(n: Column) -> Column:
    """All text of a node with its inner white space as it stands."""
    return _loose(_raw(n))


def _loose(raw: Column) -> Column:
    return F.btrim(F.replace(raw, F.lit(BOUNDARY), F.lit("")), F.lit(UNICODE_SPACES))


def shown_text(n: Column) -> Column:
    """Text of a node with its blocks on lines of their own."""
    return _shown(_raw(n))


def _shown(raw: Column) -> Column:
    lines = F.regexp_replace(raw, rf"[ \t]*+{BOUNDARY}[{BOUNDARY}\s]*+", "\n")

    def stripped(text: Column) -> Column:
        # A pattern's end is also before a last line break, even one that is no white space to it.
        breaks = reduce(lambda a, b: a | b, [F.endswith(text, F.lit(b)) for b in "\x85\u2028\u2029"])
        return F.when(breaks, F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))).otherwise(F.btrim(text, F.lit(SPACES)))

    return bound(lines, stripped)


def node_at(pos: Column) -> Column:
    return F.get(F.col("nodes"), pos)


def below(n: Column) -> Column:
    """Nodes inside a node, in document order."""
    return F.slice(F.col("nodes"), n["pos"] + 2, n["last"] - n["pos"])


def attribute(n: Column, name: str) -> Column:
    return blank_to_null(n["attrs"][name])


def class_has(n: Column, *parts: str) -> Column:
    value = F.coalesce(attribute(n, "class"), F.lit(""))
    hit = F.contains(value, F.lit(parts[0]))
    for p in parts[1:]:
        hit = hit | F.contains(value, F.lit(p))
    return hit


def class_is(n: Column, name: str) -> Column:
    return F.array_contains(n["classes"], name)


def first_below(n: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(below(n), test), F.lit(0))


def _money(text: Column) -> Column:
    return text.rlike(R.MONEY_LOOSE)


def _is_link(n: Column) -> Column:
    return (n["tag"] == "a") & attribute(n, "href").isNotNull()


@dataclass(frozen=True)
class CardRule:
    """How a retailer's cards are found on a page.

    ``starts`` names the nodes that start a card; ``judged`` makes what the page's nodes are judged by, once per page;
    ``climb`` goes from a start to the card, over ``levels`` nodes at most, the start included; ``read`` reads the card, and
    ``counts`` says whether it counts. ``shortest`` is the least length of a card's text. Cards may be of any length:
    ``widest`` only ends the choice of the widest of several candidates, and one beyond it is taken if there is no other.
    """

    starts: Callable[[Column], Column]
    judged: Callable[["CardRule"], Column]
    climb: Callable[[Column, Column, "CardRule"], Column]
    read: Callable[[Column, Column, Column], Column]
    counts: Callable[[Column], Column]
    levels: int = 1
    shortest: int = 0
    widest: int | None = None


# A retailer's climbing rule asks the same of every ancestor, so each node is judged once per page, from its text;
# climbing then reads these numbers only. 0: no card, 1: a card, 2: a card with actions, 3 and 4: the same, but wide.
# Every pattern of money asks for its sign, so the texts of nodes without one are not even made.
def _fits(n: Column, kind: Callable[[Column], Column]) -> Column:
    return bound(_raw(n), lambda raw: F.when(F.contains(raw, F.lit("$")), kind(raw)).otherwise(0))


def _fits_labelled(n: Column, rule: CardRule) -> Column:
    # The text with all its white space is no shorter, and seldom has to be made.
    long = lambda raw, t: (F.length(t) >= rule.shortest) | (F.length(_loose(raw)) >= rule.shortest)
    return _fits(n, lambda raw: bound(_flat(raw), lambda t: (_money(t) & long(raw, t)).cast("int")))


def _fits_selected(n: Column, rule: CardRule) -> Column:
    return _fits(n, lambda raw: bound(_flat(raw), lambda t: (_money(t) & (F.length(t) >= rule.shortest)).cast("int")))


def _fits_with_actions(n: Column, rule: CardRule) -> Column:
    fits = lambda t: t.rlike(R.MONEY_AMOUNT) & (F.length(t) >= rule.shortest)
    named = lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in ("agregar", "comparar", "favoritos")])
    acts = lambda t: bound(F.lower(t), named).cast("int")
    wide = lambda t: F.lit(0) if rule.widest is None else 2 * (F.length(t) > rule.widest).cast("int")
    return _fits(n, lambda raw: bound(_shown(raw), lambda t: F.when(fits(t), 1 + acts(t) + wide(t)).otherwise(0)))


def _fits_with_price(n: Column, rule: CardRule) -> Column:
    return F.contains(_raw(n), F.lit("$")).cast("int")


def _climbed(n: Column, fits: Column, levels: int, *kinds: int) -> Column:
    """Positions of the node and its ancestors that are of one of the kinds (by default, that fit), nearest first."""
    wanted = (lambda k: k.isin(*kinds)) if kinds else (lambda k: k > 0)
    return F.filter(F.slice(n["up"], 1, levels), lambda p: wanted(F.get(fits, p)))


def _nearest_or_widest(n: Column, fits: Column, rule: CardRule) -> Column:
    """The nearest fitting node on the way up, else the last one in reach."""
    above = F.try_element_at(F.slice(n["up"], 1, rule.levels + 1), F.lit(-1))
    return node_at(F.coalesce(F.get(_climbed(n, fits, rule.levels), F.lit(0)), above))


def _card_with_actions(n: Column, fits: Column, rule: CardRule) -> Column:
    """The nearest fitting ancestor that shows a card's actions, else the widest fitting one; wide ones come after these,
    the nearest first."""
    nearest = lambda *kinds: F.get(_climbed(n, fits, rule.levels, *kinds), F.lit(0))
    widest = F.try_element_at(_climbed(n, fits, rule.levels, 1, 2), F.lit(-1))
    return node_at(F.coalesce(nearest(2), widest, nearest(4), nearest(3), F.get(n["up"], F.lit(1)), n["pos"]))


def _card_with_price(n: Column, fits: Column, rule: CardRule) -> Column:
    return node_at(F.coalesce(F.get(_climbed(n, fits, rule.levels), F.lit(0)), F.get(n["up"], F.lit(rule.levels - 1)), n["pos"]))


def _texts(n: Column, test: Callable[[Column], Column], keep: Callable[[Column], Column]) -> Column:
    found = F.transform(F.filter(below(n), test), flat_text)
    return F.array_distinct(F.filter(found, keep))


def _nothing() -> Column:
    return F.lit(None).cast("string")


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _card(href, product, text, selling=None, regular=None, price_texts=None, promo_texts=None, data_pid=None,
          brand=None) -> Column:
    blank = _nothing()
    return F.struct(
        href.alias("href"),
        product.alias("product"),
        (blank if selling is None else selling).alias("selling"),
        (blank if regular is None else regular).alias("regular"),
        (_no_texts() if price_texts is None else price_texts).alias("price_texts"),
        (_no_texts() if promo_texts is None else promo_texts).alias("promo_texts"),
        text.alias("text"),
        (blank if data_pid is None else data_pid).alias("data_pid"),
        (blank if brand is None else brand).alias("brand"),
    )


def _image_alt(card: Column) -> Column:
    image = first_below(card, lambda d: (d["tag"] == "img") & attribute(d, "alt").isNotNull())
    return attribute(image, "alt")


def _longer_than(text: Column, size: int) -> Column:
    return F.when(F.length(text) > size, text)


def _labelled(a: Column, card: Column, _: Column) -> Column:
    product = F.coalesce(
        _longer_than(attribute(a, "aria-label"), 4), _longer_than(flat_text(a), 4), _image_alt(card)
    )
    return _card(attribute(a, "href"), product, flat_text(card))


def _has_test_id(n: Column, part: str) -> Column:
    return F.contains(F.coalesce(attribute(n, "data-testid"), F.lit("")), F.lit(part))


def _priced_text(card: Column, tests) -> Column:
    return F.coalesce(*[
        (lambda t: F.when(_money(t), t))(flat_text(first_below(card, test))) for test in tests
    ])


def _selected(a: Column, card: Column, _: Column) -> Column:
    heading = first_below(card, lambda d: d["tag"].isin("h2", "h3") | class_has(d, "productName", "product-name"))
    product = F.coalesce(
        attribute(a, "aria-label"), attribute(a, "title"), blank_to_null(flat_text(heading)), _image_alt(card),
        blank_to_null(flat_text(a)),
    )
    return _card(
        attribute(a, "href"),
        product,
        flat_text(card),
        selling=_priced_text(card, [
            lambda d: class_has(d, "sellingPriceValue"), lambda d: class_has(d, "sellingPrice"),
            lambda d: class_has(d, "selling-price"), lambda d: _has_test_id(d, "selling"),
        ]),
        regular=_priced_text(card, [
            lambda d: class_has(d, "listPriceValue"), lambda d: class_has(d, "listPrice"),
            lambda d: class_has(d, "list-price"), lambda d: _has_test_id(d, "list"),
        ]),
        price_texts=_texts(card, lambda d: class_has(d, "price") | _has_test_id(d, "price"), _money),
        promo_texts=_texts(card, lambda d: class_has(d, "promo", "discount", "badge"), lambda t: t != ""),
    )


def _with_actions(a: Column, card: Column, _: Column) -> Column:
    return bound(shown_text(card), lambda text: _read_with_actions(a, card, text))


def _read_with_actions(a: Column, card: Column, text: Column) -> Column:
    title_node = first_below(
        card,
        lambda d: d["tag"].isin("h2", "h3", "h4")
        | F.lower(F.coalesce(attribute(d, "class"), F.lit(""))).rlike("name|title"),
    )
    line = F.get(
        F.filter(
            F.transform(F.split(text, r"\n+"), lambda x: F.trim(x)),
            lambda x: ~x.rlike(R.MONEY_AMOUNT)
            & ~x.rlike("(?i)Agregar|Comparar|Oferta|Favoritos")
            & (F.length(x) > 8),
        ),
        F.lit(0),
    )
    brand_node = first_below(card, lambda d: F.contains(F.lower(F.coalesce(attribute(d, "class"), F.lit(""))), F.lit("brand")))
    name = F.coalesce(
        blank_to_null(shown_text(a)), attribute(a, "aria-label"), attribute(a, "title"),
        blank_to_null(shown_text(title_node)), line,
    )
    return _card(
        attribute(a, "href"),
        name,
        text,
        data_pid=F.coalesce(
            attribute(card, "data-product-id"), attribute(card, "data-part-number"), attribute(a, "data-product-id")
        ),
        brand=blank_to_null(shown_text(brand_node)),
    )


def _with_price(n: Column, card: Column, _: Column) -> Column:
    def is_product_link(d: Column) -> Column:
        return (d["tag"] == "a") & F.contains(F.coalesce(attribute(d, "href"), F.lit("")), F.lit("/p/"))

    link = F.when(is_product_link(n), n).otherwise(first_below(card, is_product_link))
    return bound(link, lambda found: _read_with_price(n, card, found))


def _read_with_price(n: Column, card: Column, link: Column) -> Column:
    code = F.coalesce(
        attribute(n, "data-product-code"), attribute(n, "data-product-id"), attribute(n, "data-code"),
        attribute(card, "data-product-code"), attribute(card, "data-product-id"),
    )
    title = F.coalesce(attribute(link, "title"), attribute(link, "aria-label"), blank_to_null(shown_text(link)))
    return _card(attribute(link, "href"), title, shown_text(card), data_pid=code)


def _tile(_: Column, tile: Column, boxes: Column) -> Column:
    def page_link(d: Column) -> Column:
        return (d["tag"] == "a") & F.contains(F.coalesce(attribute(d, "href"), F.lit("")), F.lit(".html"))

    def name_link(d: Column) -> Column:
        return (d["tag"] == "a") & class_is(d, "product-tile--link")

    def boxed(d: Column) -> Column:
        # At any depth: the box's nodes are a run of positions.
        return F.exists(boxes, lambda box: (box["pos"] < d["pos"]) & (d["pos"] <= box["last"]))

    def quick(d: Column) -> Column:
        return attribute(d, "data-quickview") == F.lit("false")

    link = first_below(
        tile, lambda d: page_link(d) & (class_is(d, "product-tile--link") | boxed(d) | F.coalesce(quick(d), F.lit(False)))
    )
    detail_box = first_below(tile, lambda d: class_is(d, "pdp-link"))
    image = first_below(tile, lambda d: (d["tag"] == "img") & class_is(d, "tile-image"))
    pid_node = first_below(tile, lambda d: attribute(d, "data-pid").isNotNull())
    list_box = first_below(tile, lambda d: class_is(d, "list"))
    prices = F.array(
        flat_text(first_below(tile, lambda d: class_is(d, "sales"))),
        flat_text(first_below(list_box, lambda d: class_is(d, "value"))),
        flat_text(list_box),
        flat_text(first_below(tile, lambda d: class_is(d, "price") & class_is(d, "product-tile--price"))),
    )
    return _card(
        attribute(link, "href"),
        F.coalesce(
            blank_to_null(flat_text(first_below(tile, name_link))),
            blank_to_null(flat_text(first_below(detail_box, lambda d: d["tag"] == "a"))),
            attribute(image, "alt"),
        ),
        flat_text(tile),
        price_texts=F.array_distinct(F.filter(prices, lambda t: t != "")),
        promo_texts=_texts(
            tile,
            lambda d: class_is(d, "product-badge") | class_is(d, "badge-label-coupons") | class_has(d, "promo"),
            lambda t: t != "",
        ),
        data_pid=F.coalesce(attribute(tile, "data-pid"), attribute(pid_node, "data-pid")),
    )


def _links(retailer_id: str):
    pattern = R.BY_ID[retailer_id].link_pattern
    return lambda n: _is_link(n) & attribute(n, "href").rlike(pattern)


def _coded_or_linked(n: Column) -> Column:
    coded = [attribute(n, a).isNotNull() for a in ("data-product-code", "data-product-id", "data-code")]
    return _links("farmacias-san-pablo")(n) | coded[0] | coded[1] | coded[2]


def _is_tile(n: Column) -> Column:
    return class_is(n, "product-tile") & class_is(n, "js-product-card")


def _itself(n: Column, _: Column, __: CardRule) -> Column:
    return n


def _judged(fits: Callable[[Column, CardRule], Column]) -> Callable[[CardRule], Column]:
    return lambda rule: F.transform("nodes", lambda n: fits(n, rule))


def _boxes(_: CardRule) -> Column:
    return F.filter("nodes", lambda n: class_is(n, "pdp-link"))


# How far each rule climbs, the shortest text of a card, and where the choice of the widest ends.
CARD_RULES = {
    "soriana": CardRule(_is_tile, _boxes, _itself, _tile, lambda c: F.lit(True)),
    "walmart": CardRule(
        _links("walmart"), _judged(_fits_labelled), _nearest_or_widest, _labelled, lambda c: _money(c["text"]), levels=10, shortest=21
    ),
    "chedraui": CardRule(
        _links("chedraui"), _judged(_fits_selected), _nearest_or_widest, _selected, lambda c: _money(c["text"]), levels=10, shortest=21
    ),
    "farmacias-guadalajara": CardRule(
        _links("farmacias-guadalajara"), _judged(_fits_with_actions), _card_with_actions, _with_actions,
        lambda c: c["text"].rlike(R.MONEY_AMOUNT) & c["product"].isNotNull(), levels=9, shortest=15, widest=3000,
    ),
    "farmacias-san-pablo": CardRule(
        _coded_or_linked, _judged(_fits_with_price), _card_with_price, _with_price, lambda c: c["text"] != "", levels=8
    ),
}


# Here only the first link to an address counts, even when no card is found around it.
FIRST_LINK_ONLY = ("walmart", "chedraui")


def _first_links(nodes: Column) -> Column:
    """The first node of each address: sorted by address and place, those that differ from the one before."""
    placed = F.transform(nodes, lambda n, at: F.struct(n["attrs"]["href"].alias("href"), at.alias("at")))
    firsts = bound(
        F.array_sort(placed),
        lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["href"] != x["href"])),
    )
    return F.transform(F.array_sort(F.transform(firsts, lambda x: x["at"])), lambda at: F.get(nodes, at))


def cards_in_nodes(nodes: DataFrame, retailer_id: str, keys: list[str], rule: CardRule | None = None) -> DataFrame:
    """Product cards of one retailer's parsed pages (see :func:`html_nodes`), in page order."""
    rule = rule or CARD_RULES[retailer_id]
    # Every value that a lambda names is bound: the optimiser would copy a column's expression into the lambda
    # and so compute it for each element.
    links = F.filter("nodes", rule.starts)
    if retailer_id in FIRST_LINK_ONLY:
        links = bound(links, _first_links)

    def read_all(found: Column) -> Column:
        cards = F.transform(links, lambda n: bound(rule.climb(n, found, rule), lambda card: rule.read(n, card, found)))
        return F.filter(cards, rule.counts)

    cards = nodes.select(*keys, bound(rule.judged(rule), read_all).alias("cards"))
    return cards.select(*keys, F.posexplode("cards").alias("position", "card")).select(*keys, "position", "card.*")


def extract_cards(captures: DataFrame, retailer_id: str, keys: list[str], rule: CardRule | None = None) -> DataFrame:
    """Product cards of one retailer's pages, in page order, by the retailer's rule or another.

    Cards are built inside the page's row, so the node arrays are neither copied per card nor
    shuffled. The first card per link is kept by :func:`anaquel.operators.dedup.dedup_in_page`.
    Each retailer has a small plan of its own; one plan with all rules in a CASE takes seconds to set
    up in every task. Pages of many retailers are parsed once and stored by retailer
    (:func:`anaquel.plans.extract.observations_from_pages`).
    """
    rule = rule or CARD_RULES[retailer_id]
    pages = captures.where(F.col("retailer_id") == retailer_id)
    return cards_in_nodes(html_nodes(pages, keys, max(LEVELS, rule.levels + 1)), retailer_id, keys, rule)


def pickup_links(captures: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Distinct product links of each page near pickup wording, in page order; the first ``limit`` if given.

    From a link upwards, the link itself included, up to eight nodes are looked at for the wording.
    """
    nodes = html_nodes(captures, keys)

    def near(worded: Column) -> Column:
        above = lambda n: F.exists(F.slice(n["up"], 1, 8), lambda p: F.get(worded, p))
        return F.filter("nodes", lambda n: _is_link(n) & F.contains(attribute(n, "href"), F.lit("/ip/")) & above(n))

    worded = F.transform("nodes", lambda n: flat_text(n).rlike(PICKUP_WORDS))
    hrefs = F.array_distinct(F.transform(bound(worded, near), lambda n: n["attrs"]["href"]))
    if limit is not None:
        hrefs = F.slice(hrefs, 1, limit)
    return nodes.select(*keys, F.posexplode(hrefs).alias("_at", "href")).select(*keys, "href", (F.col("_at") + 1).alias("rank"))


# What the rules of :func:`product_details` ask a node for.
DETAIL_NODES = Wanted(
    frozenset({"h1", "del", "s"}),
    frozenset({"itemprop", "data-sku", "data-product-code"}),
    frozenset({"name", "product-name", "priceTotal", "price-old", "old-price", "price-before", "product-code", "sku"}),
)


def product_details(captures: DataFrame, keys: list[str]) -> DataFrame:
    """Detail pages to raw product fields: structured data first, then markup, then text."""
    marked = with_json_ld(captures, captures.columns)
    page = html_nodes(marked, [*keys, "_ld"], levels=1, wanted=DETAIL_NODES)
    ld = F.col("_ld")

    def first(test) -> Column:
        return F.get(F.filter("nodes", test), F.lit(0))

    def text_of(test) -> Column:
        return clean_text(shown_text(first(test)))

    heads = [lambda d: d["tag"] == "h1", lambda d: class_is(d, "name"), lambda d: class_is(d, "product-name")]
    old = [
        lambda d: class_is(d, "price-old"), lambda d: class_is(d, "old-price"), lambda d: class_is(d, "price-before"),
        lambda d: d["tag"] == "del", lambda d: d["tag"] == "s",
    ]
    sku_nodes = [
        lambda d: (d["tag"] == "meta") & (attribute(d, "itemprop") == "sku"),
        lambda d: (d["tag"] == "meta") & (attribute(d, "itemprop") == "gtin13"),
        lambda d: attribute(d, "itemprop") == "sku",
        lambda d: attribute(d, "data-sku").isNotNull(),
        lambda d: attribute(d, "data-product-code").isNotNull(),
        lambda d: class_is(d, "product-code"),
        lambda d: class_is(d, "sku"),
    ]

    def sku_value(test) -> Column:
        return bound(
            first(test),
            lambda n: F.coalesce(
                attribute(n, "content"), attribute(n, "data-sku"), attribute(n, "data-product-code"), shown_text(n)
            ),
        )

    old_texts = F.flatten(F.array(*[F.transform(F.filter("nodes", t), shown_text) for t in old]))
    body = F.regexp_replace(page_text(), BOUNDARY, "\n")
    read = page.select(
        *keys,
        "_ld",
        body.alias("body_text"),
        F.coalesce(clean_text(ld["name"]), *[text_of(t) for t in heads]).alias("product"),
        text_of(lambda d: (d["tag"] == "h3") & class_is(d, "priceTotal")).alias("price_text"),
        old_texts.alias("old_texts"),
        F.array(*[sku_value(t) for t in sku_nodes]).alias("sku_values"),
    )
    priced = resolve_prices(read.withColumn("offer_price", F.get_json_object(ld["offers"], "$.price")), "detail")
    current, regular = F.col("price_current"), F.col("price_regular")
    retailer = R.BY_ID["farmacias-san-pablo"]
    return priced.select(
        *keys,
        sku_detail(ld, F.col("sku_values"), F.col("body_text"), F.col("url")).alias("sku"),
        F.coalesce(json_ld_brand(ld), infer_brand(retailer, F.col("product"), F.col("body_text"))).alias("brand"),
        "product",
        "price_current",
        "price_regular",
        percent_computed(current, regular, keep_zero=True).alias("promotion"),
        F.when(first_match(F.col("price_text"), R.MONEY_AMOUNT).isNull() & current.isNotNull(), ld["offers"])
        .otherwise(F.col("price_text"))
        .alias("price_raw"),
    )


def resolve_links(cards: DataFrame, retailer_id: str) -> DataFrame:
    return cards.withColumn("url", absolute_url(F.col("href"), R.BY_ID[retailer_id].base_url))
