"""The executable selector records render exactly to the fixed CSS values
stated in ``leadforge.params`` (no CSS parser: this test is the link)."""

from leadforge import params
from leadforge.functions.select import css
from leadforge.operators import audit, country, directory, discovery, emails, website


def test_audit_selectors():
    assert [(n, css(s)) for n, s in audit.AUDIT_SELECTORS] == params.AUDIT_SELECTORS
    assert [css(s) for s in audit.CONTAINERS] == params.AUDIT_CONTAINERS
    assert [css(s) for s in audit.PAGINATION_PROBES] == params.AUDIT_PAGINATION


def test_country_selectors():
    assert [css(s) for s in country.LOCATION_SELECTORS] == params.LOCATION_SELECTORS
    assert [css(s) for s in country.FLAG_SIBLING_SELECTORS] == params.FLAG_SIBLING_SELECTORS


def test_page_region_and_area_selectors():
    assert [(n, css(s)) for n, s in discovery.REGION_SELECTORS] == params.CONTACT_REGIONS
    assert css(emails.CONTACT_AREA_SELECTORS) == params.CONTACT_AREAS
    assert css(website.WEBSITE_BUTTON) == params.WEBSITE_BUTTON_SELECTOR


def test_directory_selectors():
    assert css(directory.LINK_SELECTOR) == params.DEFAULT_LINK_SELECTOR
    assert css(directory.PAGINATION_SELECTOR) == params.DEFAULT_PAGINATION_SELECTOR
    assert [css(s) for s in directory.NEXT_FALLBACKS] == params.NEXT_PAGE_FALLBACKS
