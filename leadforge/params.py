"""Parameter data of the engine.

Everything below the FIXED VALUES marker must equal the behaviour this engine
reproduces (word lists, dictionaries, selector lists, thresholds).  The
operators take these as default arguments, so a caller can pass other lists.
Order matters wherever a list is documented as "in order": the first match wins.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the reproduced behaviour; natural order)
# ---------------------------------------------------------------------------

# Contact page URL patterns, in priority order (P3); the first six are the
# generated URLs of P4.
CONTACT_PAGE_PATTERNS = [
    "/contact", "/contact-us", "/contacts", "/contacto", "/contatti",
    "/about", "/about-us", "/about-company", "/chi-siamo", "/quienes-somos",
    "/info", "/information", "/company", "/empresa", "/societe",
    "/legal", "/mentions-legales", "/privacy", "/impressum",
    "/team", "/staff", "/equipe", "/equipo",
]
GENERATED_PATTERN_COUNT = 6

# Link-text keywords per language.
CONTACT_KEYWORDS = {
    "english": ["contact", "contact us", "get in touch", "reach us", "about", "about us", "info"],
    "french": ["contact", "contactez-nous", "nous contacter", "à propos", "qui sommes-nous", "info"],
    "spanish": ["contacto", "contáctanos", "acerca de", "quiénes somos", "sobre nosotros", "info"],
    "italian": ["contatti", "contattaci", "chi siamo", "informazioni", "info"],
    "german": ["kontakt", "über uns", "impressum", "info"],
}

# Page regions searched for contact links, in priority order (P1).  The last
# region is the whole page.
CONTACT_REGIONS = [
    ("nav", "nav, .nav, .navigation, .navbar, .menu"),
    ("header", "header, .header"),
    ("footer", "footer, .footer"),
    ("main_menu", ".menu, .main-menu, #menu"),
    ("sidebar", ".sidebar, .side-nav"),
]

# Contact areas scanned for emails.
CONTACT_AREAS = (
    '.contact, .contact-info, .contacto, .contatti, .email, .mail, .footer, footer, '
    '[class*="contact"], [class*="email"], [class*="mail"]'
)

# Email patterns.
# Text pattern of the pipeline (no dot in the local part, one domain label).
EMAIL_TEXT_PATTERN = r"\b[A-Za-z](?:[A-Za-z0-9_-]*[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9-_]*[A-Za-z])?\.[A-Za-z]{2,6}\b"
# HTML-entity encoded "@".
EMAIL_ENTITY_PATTERN = r"\b[A-Za-z_-]+&#64;[A-Za-z-]+\.[A-Za-z]{2,6}\b"
# E5: spaces around "@".
EMAIL_SPACED_PATTERN = r"\b[A-Za-z_-]+\s*@\s*[A-Za-z-]+\.[A-Za-z]{2,6}\b"
# Quoted mailto strings in HTML or scripts.
EMAIL_JS_MAILTO_PATTERN = r"[\"']mailto:[^\"']*[\"']"
# Strict full-match check after cleaning.
EMAIL_STRICT_PATTERN = r"^[a-z0-9]([a-z0-9._-]*[a-z0-9])?@[a-z0-9]([a-z0-9.-]*[a-z0-9])?\.[a-z]{2,6}(\.[a-z]{2,3})?$"
# Format check.
EMAIL_FORMAT_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,3}$"
# Documented flexible pattern.
EMAIL_FLEXIBLE_PATTERN = r"\b[A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,6}(?:\.[A-Za-z]{2,3})?\b"
# Characters stripped from both ends (not space, not dot).
EMAIL_STRIP_CHARS = "\n\r\t<>()[]{}\",;:!?"

# Personal / placeholder domains.
PERSONAL_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "email.com",
    "aol.com", "icloud.com", "mail.com", "protonmail.com", "domain.com",
    "mysite.com", "business.com", "usercentrics.com", "snazzymaps.com",
]

# Spam / placeholder substrings of the whole address, in order.
SPAM_PATTERNS = [
    "noreply", "no-reply", "donotreply", "example", "example.com", "test@", "subscribe",
    "unsubcribe", "unsubscribe", "cookiebot", "admin@localhost", "info@example",
    "contact@example", "webmaster@", "commercial", "privacy", "email", "domain", "mail",
]

# Substrings that disqualify a website URL.
UNWANTED_WEBSITE_PARTS = [
    "hubspotusercontent", "dropbox.com", "drive.google.com",
    "onedrive.live.com", "wetransfer.com", "we.tl",
    "s3.amazonaws.com", "box.com", "sharepoint.com", "adform",
]

# Words that mark a website link.
WEBSITE_LINK_WORDS = ["website", "visit", "site", "homepage"]

# Country dictionary in match order (substring of lower-cased text).
# "US"/"USA" are upper-case keys compared with lower-cased text, so they never
# match; they are kept out of the default (quirk K1) and can be passed as extras.
COUNTRY_DICTIONARY = [
    ("france", "France"),
    ("italy", "Italy"),
    ("spain", "Spain"),
    ("germany", "Germany"),
    ("portugal", "Portugal"),
    ("austria", "Austria"),
    ("hungary", "Hungary"),
    ("romania", "Romania"),
    ("greece", "Greece"),
    ("slovenia", "Slovenia"),
    ("netherlands", "Netherlands"),
    ("belgium", "Belgium"),
    ("poland", "Poland"),
    ("czech republic", "Czech Republic"),
    ("slovakia", "Slovakia"),
    ("croatia", "Croatia"),
    ("bulgaria", "Bulgaria"),
    ("estonia", "Estonia"),
    ("latvia", "Latvia"),
    ("lithuania", "Lithuania"),
    ("malta", "Malta"),
    ("cyprus", "Cyprus"),
    ("luxembourg", "Luxembourg"),
    ("ireland", "Ireland"),
    ("denmark", "Denmark"),
    ("sweden", "Sweden"),
    ("finland", "Finland"),
    ("united kingdom", "United Kingdom"),
    ("uk", "United Kingdom"),
    ("great britain", "United Kingdom"),
    ("england", "United Kingdom"),
    ("scotland", "United Kingdom"),
    ("wales", "United Kingdom"),
    ("northern ireland", "United Kingdom"),
    ("switzerland", "Switzerland"),
    ("norway", "Norway"),
    ("iceland", "Iceland"),
    ("turkey", "Turkey"),
    ("canaada", "Canada"),
    ("deutschland", "Germany"),
    ("espana", "Spain"),
    ("españa", "Spain"),
    ("italia", "Italy"),
    ("nederland", "Netherlands"),
    ("osterreich", "Austria"),
    ("österreich", "Austria"),
    ("ceska republika", "Czech Republic"),
    ("česká republika", "Czech Republic"),
    ("polska", "Poland"),
    ("turkiye", "Turkey"),
    ("türkiye", "Turkey"),
]

# Aliases (lower-case key -> name), then the proper names accepted as is.
COUNTRY_ALIASES = [
    ("uk", "United Kingdom"),
    ("great britain", "United Kingdom"),
    ("england", "United Kingdom"),
    ("scotland", "United Kingdom"),
    ("wales", "United Kingdom"),
    ("northern ireland", "United Kingdom"),
    ("deutschland", "Germany"),
    ("espana", "Spain"),
    ("españa", "Spain"),
    ("italia", "Italy"),
    ("nederland", "Netherlands"),
    ("osterreich", "Austria"),
    ("österreich", "Austria"),
    ("czech republic", "Czech Republic"),
    ("ceska republika", "Czech Republic"),
    ("česká republika", "Czech Republic"),
    ("polska", "Poland"),
    ("turkiye", "Turkey"),
    ("türkiye", "Turkey"),
]
COUNTRY_PROPER_NAMES = [
    "France", "Italy", "Spain", "Germany", "Portugal", "Austria",
    "Hungary", "Romania", "Greece", "Slovenia", "Netherlands",
    "Belgium", "Poland", "Czech Republic", "Slovakia", "Croatia",
    "Bulgaria", "Estonia", "Latvia", "Lithuania", "Malta",
    "Cyprus", "Luxembourg", "Ireland", "Denmark", "Sweden",
    "Finland", "United Kingdom", "Switzerland", "Norway", "Iceland",
]

# Phrases that reject a country mention.
COUNTRY_NEGATIVE_PHRASES = [
    "ship to", "delivery to", "available in", "markets in",
    "operates in", "sells to", "exports to",
]

# URL segments, in order.
URL_COUNTRY_SEGMENTS = [
    ("/fr/", "France"),
    ("/de/", "Germany"),
    ("/it/", "Italy"),
    ("/es/", "Spain"),
    ("/pt/", "Portugal"),
    ("/nl/", "Netherlands"),
    ("/be/", "Belgium"),
    ("/at/", "Austria"),
    ("/pl/", "Poland"),
    ("/cz/", "Czech Republic"),
    ("/uk/", "United Kingdom"),
    ("/gb/", "United Kingdom"),
]

# The attribute that marks the directory's flag and country spans.
FLAG_SPAN_ATTR = "data-v-fc5493f1"

# C4: location selectors, in priority order.
COUNTRY_SPAN_NAMES = [
    "Germany", "France", "Italy", "Spain", "United Kingdom", "Netherlands",
    "Belgium", "Austria", "Switzerland", "Poland", "Czech Republic", "Portugal",
]
LOCATION_SELECTORS = (
    [
        'span[data-v-fc5493f1] + span[data-v-fc5493f1]',
        'span.vis-flag + span',
        'span[data-v-fc5493f1]:not([class*="flag"])',
        '.vis-flag + span',
    ]
    + [f'span:contains("{name}")' for name in COUNTRY_SPAN_NAMES]
    + [
        '[data-test="company-address"]',
        '[data-testid="company-address"]',
        '.company-address',
        '.company-location',
        '.address-details',
        '.location-info',
        '.address',
        '.location',
        '.country',
        '.company-info .address',
        '.profile-address',
        '.contact-address',
        '.contact-info',
        '.company-details',
        '.profile-info',
        '.company-profile',
        '[class*="address"]',
        '[class*="location"]',
        '[class*="country"]',
        '[class*="contact"]',
    ]
)
COUNTRY_TEXT_MAX = 500

# Flag selectors whose next sibling span holds the country, in order.
FLAG_SIBLING_SELECTORS = ['.vis-flag', '[class*="flag"]', '[class*="country"]']

# Meta tag names, in order.
GEO_META_NAMES = ["geo.country", "geo.region", "ICBM", "DC.coverage.spatial", "location"]

# The cascade stops at the first method with a result, so at most one
# candidate exists and the reference's method-priority sort never reorders it;
# the order is that of ``operators.country.country_columns``.

# Website button.
WEBSITE_BUTTON_SELECTOR = 'a.website-button, a[class*="website-button"]'

# Fallback next-page selectors, in order.
NEXT_PAGE_FALLBACKS = [
    'a[aria-label="Next page"]',
    '.pagination a[rel="next"]',
    '.pagination .next',
    'a:contains("Next")',
    'a[href*="pg-"]',
]

# Listing defaults: link selector and next selector of the config file, the
# pipeline's max_pages default and the per-sector company cap of main().
DEFAULT_LINK_SELECTOR = 'a[data-test="company-name"]'
DEFAULT_PAGINATION_SELECTOR = 'a[aria-label="Next page"]'
DEFAULT_MAX_PAGES = 2
DEFAULT_COMPANY_LIMIT = 20

# P5/E12 caps.
MAX_CONTACT_PAGES = 5
MIN_FOUND_LINKS = 3
EARLY_STOP_EMAILS = 5
PAGE_LABEL_CHARS = 20

# Q1: audit selectors, in list order.
AUDIT_SELECTORS = [
    ("original", 'a[href*="/companies/"][href*=".html"]:not([href*="pg-"])'),
    ("company_title", 'a.company-title, .company-title a'),
    ("company_name", '.company-name a, a.company-name'),
    ("business_name", '.business-name a, a.business-name'),
    ("listing_title", '.listing-title a, a.listing-title'),
    ("search_results", '.search-result a[href*="/companies/"], .result-item a[href*="/companies/"]'),
    ("result_links", '.result a[href*="/companies/"], .results a[href*="/companies/"]'),
    ("card_title", '.card-title a, a.card-title'),
    ("card_header", '.card-header a, .card h3 a, .card h2 a'),
    ("card_link", '.card a[href*="/companies/"]'),
    ("all_company_links", 'a[href*="/companies/"]'),
    ("html_company_links", 'a[href*="/companies/"][href$=".html"]'),
    ("europages_companies", 'a[href^="https://www.europages.co.uk/companies/"]'),
    ("main_links", 'main a[href*="/companies/"], #main a[href*="/companies/"]'),
    ("content_links", '.content a[href*="/companies/"], #content a[href*="/companies/"]'),
    ("list_item_links", 'li a[href*="/companies/"], .list-item a[href*="/companies/"]'),
    ("listing_links", '.listing a[href*="/companies/"], .listings a[href*="/companies/"]'),
    ("data_company", '[data-company] a, a[data-company]'),
    ("data_business", '[data-business] a, a[data-business]'),
    ("h_tag_links", 'h1 a[href*="/companies/"], h2 a[href*="/companies/"], h3 a[href*="/companies/"]'),
    ("div_company_links", 'div a[href*="/companies/"][href*=".html"]'),
]
AUDIT_EXAMPLES = 3
AUDIT_EXAMPLE_CHARS = 40

# Q5: container selectors, and Q6 pagination probes, in list order.
AUDIT_CONTAINERS = [
    'div[class*="company"]',
    'div[class*="business"]',
    'div[class*="result"]',
    'div[class*="listing"]',
    'div[class*="card"]',
    '.search-results, .results, .listings',
    'main, #main, .main-content, .content',
]
AUDIT_PAGINATION = [
    '.pagination', '.pager', '.page-nav',
    'a[href*="pg-"]', 'a[href*="page"]',
    '.next', '.next-page', '[rel="next"]',
]

# Sector keyword lists of the pipeline's main() (business domains, E9), as
# written (duplicates included; they are sets in use).
SECTOR_KEYWORDS = {
    "wine": ["winery", "vineyard", "vignoble", "weingut", "vino", "wine",
             "domaine", "chateau", "bodega", "cantina", "vinicola"],
    "cnc": ["cnc", "machining", "mechanical", "precision", "manufacturing",
            "metal", "turning", "milling", "industrial", "engineering",
            "metalworking", "fabrication", "tooling", "automation"],
    "energy_storage": ["energy", "storage", "battery", "power", "renewable", "solar", "wind",
                       "grid", "electrical", "energytech", "lithium", "storagebattery", "greenenergy",
                       "cleanenergy", "energytech", "storagepower"],
    "pharma": ["pharma", "pharmaceutical", "biotech", "biotech", "health", "healthcare",
               "med", "medicine", "clinical", "drug", "therapeutics", "life-sciences",
               "lifescience", "bioscience", "medtech", "biopharma"],
    "textile": ["textile", "fabric", "apparel", "clothing", "garment", "fashion", "weaving",
                "knitting", "yarn", "cotton", "wool", "synthetic", "fiber", "textiles",
                "garments", "cloth", "tailoring"],
}
