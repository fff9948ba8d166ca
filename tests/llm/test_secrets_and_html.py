from __future__ import annotations

import math
import random
import re

from archivesearch.llm.html_extract import extract, importance, main_text, site_trees
from archivesearch.llm.secrets import find_secrets, joined

KEY = "abcdEFGH0123" * 3 + "wxYZ"


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_base_spans_and_links(table):
    access = "AKIA" + "ABCDEFGH12345678"
    rows = [(1, f"{access} then {KEY} at https://host/x"), (2, f"{KEY} https://host"), (3, None), (4, ""),
            (5, f"é token = \"{'a' * 30}\" password=token :abcdefgh AKIAXAKIA {'0f' * 20}"),
            (6, f"{access}{' ' * 900}{KEY}"), (7, "ſecret=abcdefgh SECRET: short Api_Key='longer.value'"), (7, access)]
    got = find_secrets(table(rows)).select("id", joined("base").alias("b"), joined("spans").alias("s")).collect()
    assert sorted((r.id, r.b) for r in got) == sorted((i, base(t)) for i, t in rows)
    spans = {r.id: r.s for r in got if r.id != 7}
    assert "secret:26:66" in spans[1] and "endpoint:70:84" in spans[1]
    assert spans[2] == spans[3] == "" and "secret" not in spans[6]


def test_key_of_env_json_and_blank_forms(table):
    access = "AKIA" + "ABCDEFGH12345678"
    forms = [f"AWS_ACCESS_KEY_ID={access}\nAWS_SECRET_ACCESS_KEY={KEY}\nURL=https://host/x",
             f'{{"AccessKeyId": "{access}", "SecretAccessKey": "{KEY}", "url": "https://host/x"}}',
             f"aws_access_key_id = {access}\naws_secret_access_key = {KEY}\nurl = https://host/x",
             f"export AWS_ACCESS_KEY_ID='{access}' AWS_SECRET_ACCESS_KEY='{KEY}' URL='https://host/x'"]
    rows = [*enumerate(forms), (9, f"AWS_SECRET_ACCESS_KEY={KEY}"), (10, f"{access} x={KEY}="), (11, f"{access} x={KEY}a")]
    spans = {r.id: r.s for r in find_secrets(table(rows)).select("id", joined("spans").alias("s")).collect()}
    for i, text in enumerate(forms):
        at, url = text.index(KEY), text.index("https")
        assert f"secret:{at}:{at + 40}" in spans[i] and f"endpoint:{url}:{url + 14}" in spans[i], text
    assert spans[9] == "" and "secret" not in spans[10] and "secret" not in spans[11]


def test_main_text(table):
    page = ("<html><head><title>t</title></head><body><nav><a>menu</a></nav><article><h1>A &amp; b</h1><p><b>one\n two.<br><p>thr<i>ee</i>"
            "</article><div class='comments'><p>reader</p></div><form><p>f</p></form><footer>foot</footer><script>x</script>")
    assert main_text(page, frozenset()) == "A & b one two. three"
    rows = [(1, "http://h/1", page), (2, None, None), (3, "http://h/2", ""), (1, "http://h/1", page)]
    out = extract(table(rows, "page_id bigint, url string, html string")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in out) == [
        (1, "A & b one two. three", 20), (1, "A & b one two. three", 20), (2, "", 0), (3, "", 0)]


def test_paths_do_not_grow_with_ids_and_importance_equals_the_recursion(spark, table):
    page = ("<body><div id='sidebar-left'><p>menu</p></div><article id='slug-{w}'><h2 id='about-{w}'>{w} title</h2><p class='w-1/2'>text {w}"
            "</p>{more}</article></body>")
    names = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    rows = [("h", page.format(w=w, more="<p>more</p>" * (i % 3))) for i, w in enumerate(names)]
    tree = site_trees(table(rows, "host string, html string"))
    nodes = {r.path: r for r in tree.collect()}
    assert not any("slug" in p or "about" in p for p in nodes) and "/body/div.sidebar-left/p/#text" in nodes
    assert nodes["/body/article/h2"].instances == len(names)

    def of(path):
        r = nodes[path]
        if r.styled is None:
            return (1 - min(1, r.word_logs / r.words / math.log(r.instances)) if r.instances > 1 else 1.0) if r.words else 0.0
        entropy = max(0, math.log(r.styled) - r.style_logs / r.styled) / math.log(r.styled) if r.styled > 1 else 1.0
        below = [n for p, n in nodes.items() if p and p.rsplit("/", 1)[0] == path]
        return (1 - 0.9 ** r.styles) * entropy + 0.9 ** r.styles * sum(n.share / r.styled * of(n.path) for n in below)

    got = {r.path: r.importance for r in importance(tree).collect()}
    assert got.keys() == nodes.keys() and all(abs(got[p] - of(p)) < 1e-9 for p in nodes)


def test_wrappers_named_like_furniture_stay(table):
    words = [f"alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i}" for i in range(6)]
    wraps = ["<div class='content has-sidebar'>{}</div>", "<div class='layout-no-sidebar'>{}</div>", "<form action=x>{}</form>",
             "<div class='entry-content with-ads'>{}</div>", "<div class='post comments-open'>{}</div>",
             "<article><div class='article-body nav-tabs'>{}</div></article>", "<div id='page-with-menu'>{}</div>"]
    rows, want = [], {}
    for h, wrap in enumerate(wraps):
        for i, w in enumerate(words[:1 if h % 2 else 6]):  # hosts of one page too
            body = f"<h1>{w}</h1><p>{w} one</p><p>{w} two</p><div class='comments'><p>reader {w}</p></div>"
            rows.append((100 * h + i, f"http://h{h}/{i}", "<body><nav>menu</nav>" + wrap.format(body) + "<aside>related</aside></body>"))
            want[100 * h + i] = f"{w} {w} one {w} two"
    out = {r.page_id: r.text for r in extract(table(rows, "page_id bigint, url string, html string")).collect()}
    assert out == want


def test_formulas_drawings_and_unclosed_objects_stay():
    page = ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><svg><title>t</title><path d='m'/><text>label</text></svg>"
            "<p>Open <math><mi>y<p>rest</p><object data=x><p>last</p></article>")
    assert main_text(page, frozenset()) == "Let x=1 be. label Open y rest last"


def test_unnamed_menus_and_notices_go(table):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    sentence = lambda n: " ".join(word() for _ in range(n))
    notices, rows, want = [sentence(8) for _ in range(4)], [], {}
    for i in range(12):
        menu = "".join(f"<li><a href=x>{word()}</a></li>" for _ in range(5))  # not the same on any two pages
        title, one, two = sentence(4), sentence(30), sentence(25)
        rows.append((i, f"http://h/{i}", f"<body><div class=x1><ul>{menu}</ul></div><div class=x2>{rng.choice(notices)}</div>"
                     f"<div class=x3><h1>{title}</h1><p>{one} <a href=y>linked words</a></p><p>{two}</p></div><div class=x4>{rng.choice(notices)}</div></body>"))
        want[i] = f"{title} {one} linked words {two}"
    rows.append((99, "http://one/", "<body><div><a href=x>menu item</a></div><div class=x3><p>text of a page</p></div></body>"))
    want[99] = "text of a page"
    assert {r.page_id: r.text for r in extract(table(rows, "page_id bigint, url string, html string")).collect()} == want


def test_long_comment_sections_go(table):
    rng = random.Random(6)
    sentence = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))
    shapes = ["<body><article><p>{a}</p></article><div class='comments'><p>{c}</p></div></body>",
              "<body><div><h1>{a}</h1></div><section id='comments-list'><h2>Readers</h2><article><p>{c}</p></article></section></body>",
              "<body><h2>{a}</h2><ol class='commentlist'><li>{c}</li></ol></body>",
              "<body><div class='comments-page'><h1>{a}</h1><div class='replies'><p>{c}</p></div></div></body>"]
    rows, want = [], {}
    for h, shape in enumerate(shapes):
        for i in range(8 if h % 2 == 0 else 1):
            a, c = sentence(24), sentence(240)
            rows.append((100 * h + i, f"http://h{h}/{i}", shape.format(a=a, c=c)))
            want[100 * h + i] = a
    out = {r.page_id: r.text for r in extract(table(rows, "page_id bigint, url string, html string")).collect()}
    assert out == want


def test_made_up_class_names_are_one_path(table):
    rng = random.Random(7)
    name = lambda: "css-" + "".join(rng.choices("abcdefghijkmnpqrstuvwxyz0123456789", k=6))
    page = "<body><div class='{}'><ul class='{}'><li>menu</li></ul></div><main><p class='{}'>text {}</p></main></body>"
    rows = [("h", page.format(name(), name(), name(), i)) for i in range(9)]
    paths = {r.path for r in site_trees(table(rows, "host string, html string")).collect()}
    assert len(paths) == 9 and "/body/div.css/ul.css/li" in paths


def test_html_edge_cases(spark, table):
    schema = "page_id bigint, url string, html string, host string, noise string, text string, path int"
    assert extract(table([], schema)).count() == 0
    long = " ".join(f"word{i}" for i in range(200_000))
    rows = [(1, "http://h/1", f"<article><p>{long}</p></article>", "x", "y", "z", 3), (2, "http://h/2", None, "x", "y", "z", 3)]
    out = {r.page_id: (r.text, r.n_chars) for r in extract(table(rows, schema)).collect()}
    assert out == {1: (long, len(long)), 2: ("", 0)}
