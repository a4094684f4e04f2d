from ledgermill.llm import wrappers
from tests.llm.samples import sentence

SCHEMA = "page_id bigint, url string, html string, host string, text string, wrapper string"


def table(spark, pages, url="https://www.example.org/a"):
    return spark.createDataFrame([(i, url, h, "x", "y", "z") for i, h in enumerate(pages)], SCHEMA)


def texts(spark, pages, **options):
    return {r.page_id: r.text for r in wrappers.extract_main_text(table(spark, pages), **options).collect()}


def page(body, k=0):
    return (
        f'<!DOCTYPE html><html lang="en"><head><title>t {k}</title><style>p{{a:b}}</style></head><body><header>Site</header>'
        f'<nav><ul><li><a href="/">Home</a></li><li>Item {k}</li></ul></nav><div class="cookie-notice">We use cookies</div>'
        f'<script>var x = "</p>";</script><!-- note --><div class="ad">Buy {k}</div>{body}'
        f'<div id="comments"><p>First! {k}</p></div><form><label>Mail</label><input></form>'
        f'<aside>More</aside><footer>&copy; 2024</footer></body></html>'
    )


def test_article_without_the_rest(spark):
    pages = [
        page("<article><h1>Head &amp; line</h1><p>One <b>bo</b>ld\n  text<br>next</p><div class='share'>Share</div>"
             "<p>Two&nbsp;&eacute;&#33; a &lt; b</p></article>"),
        page("<main><p>Just <i>this</i></p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></main>"),
        "<article><p>Cut off &am",
        "<article><p>Cut in a tag</p><a href='x",
        "<article><p><b>Open<p>ends <p>here</article> out",
        "<p>No article</p><p><a href='/'>only links</a></p><p hidden>h</p><p style='display: none'>n</p>",
        "plain text",
        "",
        None,
        '<article><p title="a > b">quoted</p><p class=x"y>odd</p><textarea>t</textarea></article>',
    ]
    assert texts(spark, pages) == {
        0: "Head & line One bold text next Two é! a < b",
        1: "Just this x y 1 2",
        2: "Cut off &am",
        3: "Cut in a tag",
        4: "Open ends here",
        5: "No article",
        6: "plain text",
        7: "",
        8: "",
        9: "quoted odd",
    }


def test_constant_slots_are_template(spark):
    def body(k):
        extra = f"<ul><li>item {k}</li></ul>" * (k % 3)
        return f"<article><h1>{sentence(k, 5)}</h1>{extra}<p>{sentence(k + 50, 20)}</p><div><span>Read our rules first.</span></div></article>"

    got = texts(spark, [page(body(k), k) for k in range(30)])
    for k in range(30):
        lists = [f"item {k}"] * (k % 3)
        assert got[k] == " ".join([sentence(k, 5), *lists, sentence(k + 50, 20)])


def test_copies_of_an_article_are_no_template(spark):
    pages = [page(f"<article><h1>Same</h1><p>{sentence(1, 40)}</p></article>", k) for k in range(40)]
    pages += [page(f"<article><h1>Other {k}</h1><p>{sentence(k, 40)}</p></article>", k) for k in range(10, 14)]
    got = texts(spark, pages)
    assert all(got[k] == "Same " + sentence(1, 40) for k in range(40))


def test_tree_matching_and_merging():
    shapes = wrappers.Shapes()
    a = shapes.load(["body", ["h1"], ["p"], ["div", ["p"], ["ul", ["li"]]]])
    b = shapes.load(["body", ["h1"], ["div", ["ul", ["li"]], ["p"]], ["footer"]])
    assert shapes.score(a, b) == shapes.score(b, a) == 5
    assert shapes.pairs(a, b) == [(0, 0), (2, 1)]
    merged = shapes.merge(a, b)
    assert shapes.score(a, merged) >= shapes.score(a, b)
    assert shapes.slots(a, merged)[0] == 0 and -1 not in shapes.slots(b, merged)


def test_repeated_rows_null_address_and_empty_table(spark):
    rows = [(1, None, page("<article>x</article>"), "a", "b", "c")] * 2
    got = wrappers.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [(1, None, "x", 1)] * 2
    assert wrappers.extract_main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_broken_page_is_read_in_one_pass():
    html = "<div class='a" * 20_000 + "<p>" * 20_000 + "<b>x" * 20_000
    root, blocks = wrappers.parse(html)
    assert root is not None and isinstance(blocks, list)


def test_deep_pages_go_through_the_whole_extraction(spark):
    broken = "<div class='a" * 20_000 + "<p>" * 20_000 + "<b>x" * 20_000
    deep = ["<article>" + "<div>" * (3000 + k) + f"text {k}" for k in range(3)]
    mixed = "<article>" + "<div><section>" * 1500 + "<p>end"
    got = texts(spark, [*deep, mixed, broken])
    assert [got[k] for k in range(4)] == ["text 0", "text 1", "text 2", "end"] and 4 in got
    shapes = wrappers.Shapes()
    a, b = (shapes.of_node(wrappers.parse(h)[0]) for h in (deep[2], mixed))
    assert shapes.load(shapes.dump(a)) == a and shapes.score(a, b) == shapes.score(b, a) == 3
    assert len(shapes.slots(a, shapes.merge(a, b))) == shapes.sizes[a]


def test_constant_texts_of_two_templates_and_of_a_rare_one(spark):
    def body(k):
        own = f"<h1>{sentence(k, 5)}</h1><p>{sentence(k + 500, 20)}</p>"
        if k % 2:
            return f"<article>{own}<div><span>Read our rules first.</span></div></article>"
        if k % 20 == 0:
            return f"<article><section><ol><li>Printed with leave.</li></ol></section>{own}</article>"
        return f"<article><table><tr><td>All rights are ours.</td></tr></table>{own}</article>"

    got = texts(spark, [page(body(k), k) for k in range(200)])
    assert got == {k: f"{sentence(k, 5)} {sentence(k + 500, 20)}" for k in range(200)}


def test_wrapper_covers_every_shape_of_a_host(spark):
    def body(k):  # 40 shapes, merged in rounds of three
        return "".join(f"<{t}>{sentence(10 * k + i, 6)}</{t}>" for i, t in enumerate(("h2", "p", "ul", "ol", "dl", "table")) if k >> i & 1)

    pages = [page(f"<article><h1>{sentence(k + 900, 5)}</h1>{body(k)}<pre>End of page.</pre></article>", k) for k in range(40)]
    got = texts(spark, pages, group=3)
    assert all(got[k] and "End of page." not in got[k] for k in range(40))
