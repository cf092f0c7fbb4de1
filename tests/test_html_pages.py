"""P5 on the real pages table against a Python html.parser extraction: text
nodes outside script/style/noscript, entities decoded once, joined by spaces."""
from html.parser import HTMLParser

from conftest import SF
from corpusflow.functions import text as T
from corpusflow.plans import inputs as I


class _Text(HTMLParser):
    SKIP = {"script", "style", "noscript"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.parts.append(data.strip())


def py_strip(html):
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(" ".join(p.parts).split())


def test_strip_html_on_pages(spark):
    pages = I.table(spark, SF, "pages")
    rows = pages.select("page_id", "html", T.strip_html("html").alias("t")).collect()
    assert rows
    bad = [r.page_id for r in rows if r.t != py_strip(r.html)]
    assert not bad, bad[:5]


def _stripped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, html string")
    return [r.t for r in df.select("i", T.strip_html("html").alias("t")).orderBy("i").collect()]


def test_markup_is_cut_where_it_really_ends(spark):
    cases = {
        "1 < 2 and 3 > 2 end": "1 < 2 and 3 > 2 end",
        '<a title="x>y">z</a>': "z",
        "<a title='x>y' b=\"'>\">z</a >q": "z q",
        "k<script>var a=1": "k",
        "k<SCRIPT type='a>b'>if (a < b) { t = '</p>' }</ScRiPt x>m": "k m",
        "<noscript><p>off</p></noscript>on<style>p{}</style>": "on",
        "a<!-- x > y -->b<!-->c": "a b c",
        "a<!-- never closed": "a",
        "<!DOCTYPE html><scripty>kept</scripty>": "kept",
        "a <3 b</p>c</ d>e<br/>f<img src='>'>g": "a <3 b c e f g",
        "&amp;copy; &lt;b&gt; &nbsp;x": "&copy; <b> x",
        "": "",
    }
    assert _stripped(spark, cases) == list(cases.values())
    assert _stripped(spark, [None]) == [""]


def test_long_markup_needs_no_stack(spark):
    page = "<p " + "a='1' " * 50_000 + ">x" + "<b>y</b>" * 50_000 + "<script>" + "var a = '<p>';" * 50_000 + "</script>z"
    assert _stripped(spark, [page]) == ["x " + "y " * 50_000 + "z"]


def test_random_markup_equals_a_character_walk(spark):
    """The same rules, one character at a time."""
    import random
    import re

    def walk(s):
        out, i, n = [], 0, len(s)

        def tag_end(k):
            quote = ""
            while k < n:
                if quote:
                    quote = "" if s[k] == quote else quote
                elif s[k] in "\"'":
                    quote = s[k]
                elif s[k] == ">":
                    return k + 1
                k += 1
            return n
        while i < n:
            if s.startswith("<!--", i):
                ends = [e for e in (re.compile("--!?>").search(s, i + 4),) if e]
                i = i + 5 if s.startswith(">", i + 4) else i + 6 if s.startswith("->", i + 4) else ends[0].end() if ends else n
            elif m := re.compile("<(script|style|noscript)(?=[\\s/>])", re.I).match(s, i):
                i = tag_end(m.end())
                close = re.compile(f"</{m[1]}(?=[\\s/>])", re.I).search(s, i)
                i = tag_end(close.end()) if close else n
            elif re.compile("</?[a-zA-Z]").match(s, i):
                i = tag_end(i + 1)
            elif re.compile("<[!?/]").match(s, i):
                i = s.index(">", i) + 1 if ">" in s[i:] else n
            else:
                out.append(s[i])
                i += 1
                continue
            out.append(" ")
        return " ".join("".join(out).split())

    rnd = random.Random(5)
    bits = ["<", ">", "a", " ", "x y", '"', "'", "<p>", "</p>", "<script>", "</script>", "<style a='>'>", "</style >", "<!--", "-->", "<b c=\"d>\">", "/", "!", "?", "<noscript>", "</noscript>"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(1, 25))) for _ in range(1500)]
    assert _stripped(spark, texts) == [walk(t) for t in texts]
