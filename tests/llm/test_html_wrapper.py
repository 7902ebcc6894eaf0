import random
import time

import pytest

from salesloom.llm import html_wrapper


def blocks(page):
    return [text for _, never, _, text in html_wrapper.blocks_of(page)[1] if not never]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<p>a  b<br>c&amp;d\n<p>e &lt;f&gt;", ["a b c&d", "e <f>"]),
        ("<ul><li>x<ul><li>y</ul><li>z</ul>tail", ["x", "y", "z", "tail"]),
        ("<script>var t='</p>';</script><style>p{}</style>q<!-- c > --><b>r</b>s", ["qrs"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("<form>f</form><nav>n</nav><div class='cookie-notice'>c</div><section id=comments><p>u</section>v", ["v"]),
        ("<span class=ad>x</span>y < z", ["y < z"]),
        ("<p title='a>b'>t</p></div></p>", ["t"]),
        ("<!-- never ends <p>x", []),
        ("<p>for(i=0;i<n;i++) then x>3</p>y", ["for(i=0;i<n;i++) then x>3", "y"]),
        ("a <b c='d\"e' f=\"<g>\">h</b> i", ["a h i"]),
        ("<p x='1>a</p><p>b", ["a", "b"]),
        ("a <b", ["a <b"]),
        ("<!x <p>y", ["y"]),
        ("a <! b", ["a <! b"]),
        ("", []),
    ],
)
def test_blocks(page, expected):
    assert blocks(page) == expected


def test_simple_tree_matching():
    a = html_wrapper.tree_of("(body(nav()div(p()h2()p.x())footer()))")
    b = html_wrapper.tree_of("(body(div(h2()p.x()ul())footer()aside()))")
    assert html_wrapper.matched(a, b) == {0: 0, 1: 1, 2: 3, 3: 5, 4: 6, 6: 7}


ODD = {
    "deep": "<div>" * 20_000 + "x" + "</div>" * 20_000,
    "unclosed": "<p>x" + "<a " * 300_000,
    "quotes": "<p>x" + '<a ">" ' * 100_000 + '"',
    "declarations": "<p>x" + "<!" * 300_000,
    "closers": "<div>" * 20_000 + "x" + "</i>" * 20_000,
    "names": f"<div class='{'advert_' * 300}!'>x",
    "brackets": "<p>x" + "".join(f"<a{k});(>" for k in range(20)),
}


@pytest.mark.parametrize("kind", ODD)
def test_odd_pages_take_one_pass(kind):
    begin = time.monotonic()
    root, found = html_wrapper.blocks_of(ODD[kind])
    signature = html_wrapper.signature_of(root)
    tree = html_wrapper.tree_of(signature)
    assert found[0][3].startswith("x") and signature == html_wrapper.signature_of(tree)
    aligned = html_wrapper.matched(tree, tree)
    assert all(a == b for a, b in aligned.items()) and len(aligned) == signature.count("(")
    assert time.monotonic() - begin < 20


def test_odd_pages_among_others(spark):
    rows = [(k, "http://h/", html) for k, html in enumerate(ODD.values())]
    rows += [(100 + k, f"http://h/{k}", f"<div class=a>Home Shop</div><p>Story {k}</p>") for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_wrapper.extract(pages).collect()}
    assert len(found) == len(rows) and all(found[k].startswith("x") for k in range(len(ODD)))
    assert found[105] == "Story 5"


def test_matching_against_all_alignments():
    rng = random.Random(8)

    def tree(depth):
        labels = rng.sample("abcd", rng.randint(0, 4)) if depth else []
        return "".join(f"{label}({tree(depth - 1)})" for label in labels)

    def largest(a, b):
        """Most nodes that an order-preserving alignment of two nodes of one label has."""
        first, second = list(a.children.values()), list(b.children.values())

        def best(i, j):
            if i == len(first) or j == len(second):
                return 0
            taken = largest(first[i], second[j]) + best(i + 1, j + 1) if first[i].label == second[j].label else 0
            return max(taken, best(i + 1, j), best(i, j + 1))

        return 1 + best(0, 0)

    for _ in range(100):
        a, b = (html_wrapper.tree_of(f"({tree(3)})") for _ in range(2))
        assert len(html_wrapper.matched(a, b)) == largest(a, b)
    assert html_wrapper.matched(html_wrapper.tree_of("a()"), html_wrapper.tree_of("b()")) == {0: 0}


def page(k, words):
    """No class or tag of this page tells the menu and the closing line from the story."""
    return f"<div><div class=a>Home Shop</div><div class=b><p>Story {k} {words}</p><p>More {words} {k * 7}</p></div><div class=c>All rights</div></div>"


def test_template_is_induced_per_host(spark):
    rows = [(k, f"http://one.example/{k}", page(k, "x" * (k % 5))) for k in range(40)]
    rows += [(100 + k, f"http://two.example/{k}", "<div><div class=a>Home Shop</div><p>only copy</p></div>") for k in range(20)]
    rows += [(200, None, None), (201, "no url", ""), (None, "http://one.example/x", page(77, "null id")), (3, "http://one.example/3", page(3, "again"))]
    rows += [(202, "http://one.example/long", page(99, "word " * 100_000))]
    pages = spark.createDataFrame([(*r, "h", 1, "s") for r in rows], "page_id long, url string, html string, host string, node int, text string")
    found = {(r.page_id, r.url): r for r in html_wrapper.extract(pages).collect()}
    assert len(found) == len(rows) - 1
    assert found[5, "http://one.example/5"].text == "Story 5\nMore 35"
    assert found[100, "http://two.example/0"].text.endswith("only copy")
    assert found[200, None].text == "" and found[201, "no url"].n_chars == 0
    assert found[None, "http://one.example/x"].text == "Story 77 null id\nMore null id 539"
    assert found[202, "http://one.example/long"].n_chars > 900_000
    assert html_wrapper.extract(pages.limit(0)).collect() == []


def test_article_alone_counts(spark):
    html = "<p>outside</p><article><header>top</header><h1>T</h1><p>in</p><div class=comments><p>me too</p></div></article>"
    pages = spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")
    assert html_wrapper.extract(pages).first().text == "top\nT\nin"


def test_repeats_and_copies_are_no_template(spark):
    def story(k, paragraphs):
        return f"<article><h1>Title {k}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"

    def plain(k, paragraphs):
        return f"<div class=a>Home Shop</div><div class=b><h1>Title {k}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</div>"

    rows, expected = [], {}
    for base, host, make in ((0, "lines.example", story), (10_000, "plain.example", plain)):
        for k in range(20):
            paragraphs = [f"paragraph {k} {n} of {host}" for n in range(3)]
            rows.append((base + k, f"http://{host}/{k}", make(k, paragraphs)))
            expected[base + k] = "\n".join([f"Title {k}", *paragraphs])
        rows.append((base + 99, f"http://{host}/long", make(99, ["the same line"] * 5_000)))
        expected[base + 99] = "\n".join(["Title 99"] + ["the same line"] * 5_000)
        for k in range(100, 400):  # copies, and near copies with one paragraph of their own
            paragraphs = [f"copied {n}" for n in range(12)] + [f"changed {k}"] * (k % 2)
            rows.append((base + k, f"http://{host}/{k}", make("copied", paragraphs)))
            expected[base + k] = "\n".join(["Title copied", *paragraphs])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_wrapper.extract(pages).collect()} == expected


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<body class='no-sidebar'><p>a</p></body>", "a"),
        ("<html class=search><body class='side login'><p>a</p></body></html>", "a"),
        ("<div id=page class='has-search'><p>a</p><div class='ad site-footer'>x</div></div>", "a"),
        ("<article class='post comments-open'><p>a</p><div class='comments-area'><article>x</article></div></article>", "a"),
        ("<div class=sidebar><main class='content side'><p>a</p></main></div><div class=menu><p>x</p></div>", "a"),
        ("<form><div class=widget><article><p>a</p></article><article><p>b</p></article></div></form>", "a\nb"),
        ("<div class='sidebar'><p>a</p></div><nav>x</nav>", "a"),
        ("<form><p>a</p><footer>x</footer></form>", "a"),
        ("<nav>x</nav><p>a</p><div class=comment-list>x</div>", "a"),
    ],
)
def test_names_do_not_empty_a_page(spark, page, expected):
    pages = spark.createDataFrame([(1, "http://h/", page)], "page_id long, url string, html string")
    assert html_wrapper.extract(pages).first().text == expected
