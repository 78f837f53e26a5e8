"""Retailer rules as data: what differs between retailers is written here, the jobs are shared."""

from __future__ import annotations

from dataclasses import dataclass, field

# Patterns for money, discounts and promotions.
MONEY_SIGNED = r"-?[0-9]+(?:\.[0-9]{1,2})?"
MONEY_DOLLAR = r"(?U)(\$\s*[\d,]+(?:\.\d{1,2})?)"
MONEY_AMOUNT = r"(?U)\$\s*([0-9][0-9,]*(?:\.\d{1,2})?)"
MONEY_MXN = r"(?iU)(?:MXN\s*)?\$\s*([0-9][0-9,]*(?:\.\d{1,2})?)"
MONEY_LOOSE = r"(?U)\$\s*[\d,.]+"
PRICE_NOW = r"(?iU)precio\s+actual\s*(?:MXN)?\s*\$?\s*([\d,]+(?:\.\d{1,2})?)"
PRICE_BEFORE = r"(?iU)(?:Antes|costaba)\s*\$?\s*([\d,]+(?:\.\d{1,2})?)"
PERCENT_OFF = r"(?iU)\b(\d{1,2})\s*%\s*(?:de\s*)?descuento\b"
PICKUP = r"(?iU)\b(pickup|recoge|recoger|recogida)\b"
LABEL_PATTERNS = [
    r"(?iU)Rebaja",
    r"(?iU)Precio en línea",
    r"(?iU)Más vendido",
    r"(?iU)Combina\s+\d+\s*x\s*\$[\d,.]+",
    r"(?iU)Ahorra\s*\$[\d,.]+",
]
MULTIBUY_PATTERNS = [
    r"(?iU)\b\d+\s*x\s*\d+\b",
    r"(?iU)\b\d+\s*x\s*\$\s*\d+(?:\.\d+)?",
]
PROMOTIONAL = "Precio promocional"

# SKU patterns.
SKU_PATH_PATTERNS = [
    r"/([0-9]+)\.html/?$",
    r"(?i)-([0-9]{4,20})/p/?$",
    r"/([0-9]{8,20})/?$",
]
SKU_DASH_HTML = r"(?i)-(\d{5,14})\.html(?:$|[?#])"
SKU_P_PATH = r"(?i)/p/(\d+)(?:$|[/?#])"
SKU_LABELLED = r"(?iU)\b(?:SKU|UPC|EAN|Código|Codigo)\s*[:#-]?\s*(\d{6,14})\b"
SKU_HTML_PATTERNS = [
    r"""(?iU)itemprop=["']sku["'][^>]*content=["']([^"']+)""",
    r"""(?iU)<meta[^>]+content=["']([^"']+)["'][^>]+itemprop=["']sku["']""",
    r"""(?iU)itemprop=["']sku["'][^>]*>\s*([^<]+)""",
    r"""(?iU)"sku"\s*:\s*"([^"]+)\"""",
    r"""(?iU)\bSKU\b\s*</[^>]+>\s*<[^>]+>\s*([^<]+)""",
]
SKU_JSON_LD_KEYS = ["gtin13", "gtin12", "gtin", "sku", "mpn"]

# Page counters.
PRODUCTS_SHOWN = r"(?iU)\(?\b(\d+(?:[,.]\d{3})*)\s+productos?\b\)?"
PRODUCTS_FIRST = r"(?iU)\b([\d,]+)\s+Productos\b"
TOTAL_PAGES = r"""(?i)<section[^>]*\bc-pagination-carousel\b[^>]*\bdata-total-pages=["']([^"']*)["']"""
CATEGORY_KEY_COMPONENT = (
    r'(?is)"component"\s*:\s*"Infinite_EmpathySearch/js/view/search-list-component"'
    r'.*?"categoryId"\s*:\s*"?(\d+)"?'
)
CATEGORY_KEY_ANY = r'(?i)"categoryId"\s*:\s*"?(\d+)"?'
REPORTED_PRODUCTS = r"(?U)Productos únicos:\s*(\d+)"
GRID_MARKERS = ["Search-UpdateGrid", "Search-ShowAjax"]

# The range request of the search service.
BROWSE_ENDPOINT = "https://api.empathy.co/search/v1/query/fda/browse"
BROWSE_ROWS = 50
RANGE_ROWS = 20


@dataclass(frozen=True)
class Retailer:
    retailer_id: str
    display_name: str
    base_url: str
    location_id: str
    required: tuple[str, ...]
    link_pattern: str
    block_statuses: tuple[int, ...] = ()
    block_markers: tuple[str, ...] = ()
    block_text: str = "body_text"
    block_url: str | None = None
    brand_mode: str = "boundary"
    brands: tuple[str, ...] = ()
    brand_aliases: dict[str, str] = field(default_factory=dict)
    store_keyword: str | None = None
    store_full_name: str | None = None
    store_hints: tuple[str, ...] = ()
    page_parameter: str = "page"


# Retailers in run order, with their names, addresses, markers and brand lists.
RETAILERS = [
    Retailer(
        retailer_id="soriana",
        display_name="Soriana",
        base_url="https://www.soriana.com/",
        location_id="cdmx",
        required=("product", "url"),
        link_pattern=r"\.html",
        block_statuses=(403,),
        block_markers=("GF R01", "Access Denied", "Forbidden"),
        brand_mode="substring",
        brands=(
            "Colgate", "Oral-B", "Listerine", "Sensodyne", "Crest", "Gum", "Curaprox", "Philips", "Aquafresh",
            "Bexident", "Corega", "Ariel", "Pinol", "Fabuloso", "Cloralex", "Clorox", "Axion", "Harpic", "Windex",
            "Drano", "Brasso", "Flash", "Tide", "Persil", "Escudo", "Vanish", "Downy", "Suavitel", "Salvo",
            "Maestro Limpio", "Roma", "Zote", "Carisma", "Ace", "Bold", "Blanca Nieves",
        ),
    ),
    Retailer(
        retailer_id="chedraui",
        display_name="Chedraui",
        base_url="https://www.chedraui.com.mx/",
        location_id="chedraui-polanco",
        required=("product", "url"),
        link_pattern=r"(?i)/p(?:\?|$)",
        block_statuses=(401, 403, 429),
        block_markers=(
            "access denied", "forbidden", "captcha", "robot or human", "verifica tu identidad",
            "verify you are human",
        ),
        block_text="folded_body",
        brand_mode="longest",
        brands=(
            "Arm & Hammer", "Dr. Beckmann", "Blanca Nieves", "Mas Color", "Oral-B", "Sensodyne", "Listerine",
            "Aquafresh", "Bexident", "Curaprox", "Colgate", "Philips", "Corega", "Cloralex", "Oxiclean", "Suavitel",
            "Ensueño", "Vanish", "Princesa", "Downy", "Persil", "Ariel", "Carisma", "Condor", "Crest", "Tide",
            "Bold", "Zote", "Roma", "MÁS", "Ace", "GUM",
        ),
        store_keyword="polanco",
        store_full_name="selecto mexico polanco",
        store_hints=("recoger", "pickup", "tienda"),
    ),
    Retailer(
        retailer_id="farmacias-guadalajara",
        display_name="Farmacias Guadalajara",
        base_url="https://www.farmaciasguadalajara.com/",
        location_id="fg-online",
        required=("sku", "product", "price_current"),
        link_pattern=r"(?i)-\d{5,14}\.html(?:$|[?#])",
        block_markers=(
            "access denied", "verifica que eres humano", "verify you are human", "captcha", "request rejected",
        ),
        brands=(
            "Colgate", "Oral-B", "Sensodyne", "Listerine", "Gum", "Curaprox", "Prudence", "Sico", "Trojan", "Durex",
            "Playboy", "Sterimar", "Neilmed", "Pharmalife", "Lysomucil", "Tabcin", "Ariel", "Ace", "Downy",
            "Suavitel", "Ensueño", "Fuerza Max", "Vanish", "Cloralex", "Persil", "Roma", "Foca",
        ),
    ),
    Retailer(
        retailer_id="farmacias-del-ahorro",
        display_name="Farmacias del Ahorro",
        base_url="https://www.fahorro.com/",
        location_id="fahorro-online",
        required=("sku", "product", "url", "price_current"),
        link_pattern=r"\.html",
        block_markers=(
            "verify you are human", "verifica que eres humano", "access denied", "request rejected",
            "press and hold",
        ),
        block_text="spaced_html",
        brands=(
            "Sterimar", "Afrin", "Iliadin", "Neilmed", "Sinomarin", "Vick", "Durex", "Sico", "Prudence", "Trojan",
            "Playboy", "M Force", "Colgate", "Oral-B", "Sensodyne", "Listerine", "Bexident", "Gum", "Elmex",
            "Parodontax", "Curaprox", "Aquafresh", "Closeup",
        ),
        page_parameter="p",
    ),
    Retailer(
        retailer_id="farmacias-san-pablo",
        display_name="Farmacias San Pablo",
        base_url="https://www.farmaciasanpablo.com.mx/",
        location_id="san-pablo-online",
        required=("sku", "product", "price_current"),
        link_pattern=r"/p/",
        block_statuses=(403,),
        block_markers=(
            "access denied", "you don't have permission to access", "request rejected", "verify you are human",
            "verifica que eres humano",
        ),
        block_text="title_and_body",
        brands=(
            "Afrin", "Arm & Hammer", "Bexident", "Colgate", "Corega", "Curaprox", "Dentaflox", "Durex", "Fluoxytil",
            "Fullsen", "GUM", "Lacer", "Listerine", "NeilMed", "Oral-B", "Parodontax", "Playboy", "Prudence",
            "Real Sea", "Rinomar", "Sensodyne", "Sico", "Sinomarin", "Stérimar", "Sterimar", "Trojan", "Vantal",
            "Xerolacer",
        ),
        brand_aliases={"Sterimar": "Stérimar"},
        page_parameter="currentPage",
    ),
    Retailer(
        retailer_id="walmart",
        display_name="Walmart",
        base_url="https://www.walmart.com.mx/",
        location_id="sc-toreo",
        required=("sku", "product"),
        link_pattern=r"/ip/",
        block_statuses=(401, 403, 429),
        block_markers=(
            "access denied", "robot or human", "captcha", "reference #18", "forbidden", "verifica tu identidad",
            "mantén presionado", "manten presionado",
        ),
        block_text="decoded_body",
        block_url="/blocked",
        brand_mode="substring",
        brands=(
            "Colgate", "Oral-B", "Sensodyne", "Listerine", "Crest", "Equate", "Corega", "Aquafresh", "Gum",
            "Curaprox", "Philips", "Marvis", "Ariel", "Persil", "Roma", "Suavitel", "Vanish", "Cloralex", "Clorox",
            "Zote", "Ace", "Bold", "Blanca Nieves", "MAS", "Lysol", "Oxiclean", "Dr. Beckmann", "Ensueño",
            "Great Value", "Arm & Hammer", "Tide", "Downy", "Carisma",
        ),
        store_hints=("pickup", "recog"),
    ),
]
BY_ID = {r.retailer_id: r for r in RETAILERS}

# The brand list that one retailer's plain category pages use (substring matching).
CHEDRAUI_PAGE_BRANDS = (
    "Colgate", "Oral-B", "Listerine", "Sensodyne", "Crest", "GUM", "Corega", "Aquafresh", "Bexident", "Curaprox",
    "Philips", "Condor", "Suavitel", "Downy", "Ariel", "Ensueño", "Vanish", "Cloralex", "Ace", "MÁS", "Mas Color",
    "Roma", "Zote", "Persil", "Tide", "Dr. Beckmann", "Blanca Nieves", "Carisma", "Bold", "Oxiclean",
    "Arm & Hammer",
)
