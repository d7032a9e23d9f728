import datetime
import random
import time
from html.parser import HTMLParser

import pytest

from lotwise.functions import fixed
from lotwise.functions.html_cards import Address, CardReader, CardSpec, _attributes
from lotwise.operators import extract


def read(html, spec):
    return CardReader(spec).read(html)


def test_class_with_a_blank_is_the_whole_attribute_and_a_word_is_any_of_them():
    fields = {"whole": Address("p", "a b"), "word": Address("p", "a"), "any": Address("p")}
    (hits,) = read('<li><p class="a b">1</p><p class="b a">2</p><p>3</p></li>', CardSpec(Address("li"), fields))
    assert [(h[0], h[2]) for h in hits] == [
        ("whole", "1"), ("word", "1"), ("any", "1"), ("word", "2"), ("any", "2"), ("any", "3"),
    ]


def test_class_pattern_searches_words_and_the_whole_attribute():
    spec = CardSpec(Address("li"), {"f": Address("div", "^ng-tns.*ng-star$", True)})
    (hits,) = read('<li><div class="ng-tns-1 x ng-star">a</div><div class="x ng-tns ng-star">b</div></li>', spec)
    assert [h[2] for h in hits] == ["a"]


def test_children_count_elements_comments_and_merged_texts():
    spec = CardSpec(Address("li"), {"f": Address("span", "d")})
    html = '<li><span class="d"><i></i>3 &amp; beds</span><span class="d"><i></i>240m <sup>2</sup></span><span class="d">x<!--c--></span></li>'
    (hits,) = read(html, spec)
    assert [(h[2], h[4]) for h in hits] == [("3 & beds", 2), ("240m 2", 3), ("x", 2)]


def test_scripts_void_elements_and_unclosed_elements():
    spec = CardSpec(Address("li"), {"f": Address("p")}, attrs=(("f", "id"),))
    html = '<p>out<li><script>var a="</li>";</script><p id="1">a<br><img src=x>b<p id=2>c</li><li><p>d'
    cards = read(html, spec)
    assert [[(h[2], h[3]) for h in hits] for hits in cards] == [[("abc", "1"), ("c", "2")], [("d", None)]]


def test_stray_end_tags_and_self_closing_elements():
    spec = CardSpec(Address("li"), {"f": Address("b"), "g": Address("u")})
    (hits,) = read("<li></div></p><b>x</b><u/>y<b>z</b></li>", spec)
    assert [(h[0], h[2]) for h in hits] == [("f", "x"), ("g", ""), ("f", "z")]


def test_nested_cards_both_count_and_scopes_number_blocks():
    spec = CardSpec(Address("li"), {"u": Address("div", "u"), "t": Address("b")}, scope="u")
    cards = read('<li><b>0</b><div class="u"><b>1</b></div><div class="u"><b>2</b><li><b>3</b></li></div></li>', spec)
    assert [(h[0], h[1], h[2]) for h in cards[0]] == [
        ("t", None, "0"), ("u", 0, "1"), ("t", 0, "1"), ("u", 1, "23"), ("t", 1, "2"), ("t", 1, "3"),
    ]
    assert [h[2] for h in cards[1]] == ["3"]


class FullParse(HTMLParser):
    """The same reader driven by the events of a full parse."""

    def __init__(self, spec):
        super().__init__(convert_charrefs=True)
        self.reader = CardReader(spec)

    def handle_starttag(self, tag, attrs):
        raw = self.get_starttag_text()[1 + len(tag) : -1]
        assert _attributes(raw) == {k: v or "" for k, v in attrs}
        self.reader._start(tag, raw, "", 0)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.reader._end(tag)

    def handle_data(self, data):
        if self.reader.open_hits and not any(e.tag == "script" for e in self.reader.stack):
            self.reader._text(data)

    def handle_comment(self, data):
        if self.reader.open_hits:
            self.reader._count_child(False)

    def cards(self, html):
        self.feed(html)
        self.close()
        return [[hit.row() for hit in card.hits] for card in self.reader.cards]


PIECES = [
    '<div class="u">', "</div>", "<b>", "</b >", "text", " &amp; &lt;b&gt; ", "&copy", "<!-- <li> -->", "<br>",
    '<img alt="a>b">', "<p class='t u' id=\"x&amp;y\">", "</p>", '<script>var a="</b><li>";</script>', "<u/>",
    "a < b", "5>4", "<li>", "</li>", "<LI CLASS=t>", "</LI>", "<p class = t  hidden>", '<b title="=">',
    "<li class=t data-x='\"'>", "<a href=/x/y>", "</a>", "<a href='z' />", "\n", "é",
]


@pytest.mark.parametrize("seed", range(5))
def test_scanner_finds_what_a_full_parse_finds(seed):
    rnd = random.Random(seed)
    fields = {"u": Address("div", "u"), "t": Address("p", "t"), "b": Address("b"), "a": Address("a"), "l": Address("li", "t")}
    spec = CardSpec(Address("li"), fields, scope="u", attrs=(("t", "id"), ("b", "title"), ("a", "href")))
    for _ in range(300):
        html = "".join(rnd.choices(PIECES, k=rnd.randint(1, 40)))
        assert read(html, spec) == FullParse(spec).cards(html), html


def test_whole_table_scans_as_it_parses(spark, sf_dir):
    spec = CardSpec(Address("html"), {t: Address(t) for t in ("title", "h1", "p", "a", "div", "footer", "b")})
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect():
        assert read(row.html, spec) == FullParse(spec).cards(row.html)


@pytest.mark.parametrize("junk", ["<a ", '<a b="', "<!-- ", "<script>", "</", "<a b='>", "=\"'<p", "<![CDATA["])
def test_broken_markup_costs_no_more_than_its_length(junk):
    spec = CardSpec(Address("li"), {"p": Address("p")})
    started = time.perf_counter()
    cards = read("<li><p>1</p></li>" + junk * 100000, spec)
    assert time.perf_counter() - started < 5
    assert [h[2] for h in cards[0]] == ["1"]


def test_unclosed_comments_and_scripts_hide_no_cards():
    spec = CardSpec(Address("li"), {"p": Address("p")})
    for opening in ("<!-- a>", "<script>", "<style>", "<title>"):
        assert [[h[2] for h in c] for c in read(opening + "<li><p>1</p></li>", spec)] == [["1"]]


def _e(markup, name, inner, cls=None):
    tag, known = markup[name]
    return f'<{tag} class="{cls or known}">{inner}</{tag}>'


def _rows(spark, function, html, *columns):
    pages = spark.createDataFrame([(7, "u", html), (8, "v", None)], "page_id long, url string, html string")
    return [tuple(r) for r in function(pages).orderBy("page_id", "card_no").select(*columns).collect()]


def test_portal_a(spark):
    m = fixed.PORTAL_A_MARKUP
    single = _e(m, "card", "".join([
        _e(m, "price", "€550,000"), _e(m, "address", "1 Road, Co. Cork"), _e(m, "detail", "5 Bed"),
        _e(m, "detail", "4 Bath"), _e(m, "detail", "4 Bed"), _e(m, "detail", "332 m²"), _e(m, "kind", "Detached"),
    ]))
    site = _e(m, "card", "".join([
        _e(m, "price", " AMV: Price on Application "), _e(m, "address", "2 Road, Co. Cork"), _e(m, "detail", "2.5 ac"),
        _e(m, "detail", "odd"), _e(m, "detail", "B2 BER"),
    ]))
    units = [
        _e(m, "unit", _e(m, "unit_price", "€300,000") + _e(m, "unit_info", "3 Bed · 2 Bath · Terrace")),
        _e(m, "unit", _e(m, "unit_info", "9 Bed · 9 Bath · Hidden")),
        _e(m, "unit", _e(m, "unit_price", "POA") + _e(m, "unit_info", "Duplex")),
    ]
    multi = _e(m, "card", _e(m, "multi_address", "New Homes, Dublin 8") + "".join(units))
    columns = ["card_no", "Bed", "Bath", "floor_area_m2", "Price", "price_status", "Address", "Property_type", "New_build", "Page"]
    assert _rows(spark, extract.portal_a_listings, single + site + multi, *columns) == [
        (0, 5.0, 4.0, 332.0, "550000", "parsed", "1 Road, Co. Cork", "Detached", "no", 7),
        (1, None, None, 10116.951964712072, "Price on Application", "on_application", "2 Road, Co. Cork", None, "no", 7),
        (2, 3.0, 2.0, None, "300000", "parsed", "New Homes, Dublin 8", "Terrace", "yes", 7),
        (2, None, None, None, "POA", "other", "New Homes, Dublin 8", "Duplex", "yes", 7),
    ]


def test_portal_b(spark):
    m = fixed.PORTAL_B_MARKUP

    def card(price, address, *details):
        return _e(m, "card", _e(m, "price", price, "ng-tns-c1 ng-star-inserted")
                  + _e(m, "address", address, "PropertyListingCard__Address")
                  + "".join(_e(m, "detail", d) for d in details))

    html = card("€800,000", " A, Cork", "<i></i> 4 beds ", "<i></i>1 bath", "<i></i>240m <b>2</b>", "<i></i>Detached House")
    html += card("POA", "B", "<i></i>End of Terrace House", "<i></i>5ac <b>1</b>", "<i></i>three word type")
    html += card("Sale Agreed", "C", "no icon", "<i></i>1 bed", "<i></i>Studio")
    columns = ["beds", "baths", "floor_area", "Price", "Address", "Property_type", "Page"]
    assert _rows(spark, extract.portal_b_listings, html, *columns) == [
        (4.0, 1.0, "240m 2", "800000", " A, Cork", "Detached House", 7.0),
        (None, None, None, "PoA", "B", "End", 7.0),
        (1.0, None, None, "Sale Agreed", "C", "Studio", 7.0),
    ]


def test_registers(spark):
    m = fixed.SOLD_MARKUP
    sold = _e(m, "card", _e(m, "address", " 35B Park, V42r634 ") + _e(m, "date", " 2022-12-09 ")
              + _e(m, "span", "Sold") + _e(m, "span", "€205,000", "x ng-star-inserted"))
    sold += _e(m, "card", _e(m, "address", "no price"))
    assert _rows(spark, extract.sold_register, sold, "Date", "Address", "Price", "Page") == [
        (datetime.date(2022, 12, 9), "35B Park, V42r634", 205000, 7), (None, "no price", None, 7),
    ]
    m = fixed.CHANGE_MARKUP
    change = _e(m, "card", _e(m, "address", " 1 Park ") + _e(m, "date", "9 Dec 2022")
                + _e(m, "item", "<span>€5,000</span><span>(-3.57%)</span>")
                + _e(m, "item", "<span>€140,000</span><span>€135,000</span>"))
    columns = ["Date", "Address", "New_price", "Old_price", "change_eur", "change_pct"]
    assert _rows(spark, extract.change_register, change, *columns) == [
        (datetime.date(2022, 12, 9), " 1 Park ", 135000, 140000, -5000, -3.57)
    ]
