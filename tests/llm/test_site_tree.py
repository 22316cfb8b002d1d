import random
from math import isclose, log

from changelake.llm.dom import blocks, parse
from changelake.llm.site_tree import Tree, _hash, extract, learn


def lines(html):
    return [text for _, text in blocks(parse(html))]


def test_blocks_of_tolerant_markup():
    assert lines("<p>a <b>b<p>c&amp;d &#233;&nbsp;x</p>e") == ["a b", "c&d é x", "e"]
    assert lines("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>") == ["one", "two", "in", "three"]
    assert lines("<table><tr><td>1<td>2<tr><td>3</table>x") == ["1", "2", "3", "x"]
    assert lines("a<br>b\n c<!-- no --><hr>d</div></p>e") == ["a b c", "d", "e"]
    assert lines("<script>if (a<b) '</p>'</script><svg/>t &lt;p&gt; 5 < 6") == ["if (a<b) '</p>'", "t <p> 5 < 6"]
    assert lines("") == lines(" <p> </p>") == []
    assert lines("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]


def page(number, host, draw, article=True):
    words = lambda n: " ".join(draw.choice("lorem ipsum dolor sit amet elit sed".split()) + str(draw.randrange(999)) for _ in range(n))
    body = [words(12), words(9), words(15) + " &amp; caf&eacute;"]
    main = "".join(f"<p>{text}</p>" for text in body)
    wrapped = f"<article><h1>T {number}</h1>{main}</article>" if article else f"<div class='c1'><div class='body7'>{main}</div></div>"
    html = (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><div class='top'><div>Welcome to {host}</div></div>"
        f"<nav><ul><li>Home<li>About {number}</ul></nav><div class='cookie-notice'>We use cookies {words(4)}</div>{wrapped}"
        f"<div id='comments'><p>First! {words(5)}</p></div><form><label>Mail</label></form><div class='low'>All rights at {host}</div>"
        f"<footer>&copy; {host}</footer><script>x()</script></body></html>"
    )
    texts = [text.replace("&amp;", "&").replace("&eacute;", "é") for text in body]
    return html, "\n".join(([f"T {number}"] if article else []) + texts)


def test_main_text_with_and_without_an_article(spark):
    draw = random.Random(6)
    rows, expected = [], {}
    for number in range(160):
        host, article = ("a.example", True) if number < 60 else ("b.example", False)
        html, expected[number] = page(number, host, draw, article)
        rows.append((number, f"https://{host}/{number}", html, "x"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    found = {row.page_id: row for row in extract(df).collect()}
    assert {n: row.text for n, row in found.items()} == expected
    assert all(row.n_chars == len(row.text) and row.url.endswith(f"/{n}") for n, row in found.items())


def test_copies_of_one_article_stay(spark):
    html, text = page(1, "c.example", random.Random(1))
    df = spark.createDataFrame([(n, "http://c.example/", html) for n in range(40)], "page_id long, url string, html string")
    assert {row.text for row in extract(df).collect()} == {text}


def test_importances_are_entropies(spark):
    draw = random.Random(8)
    pages = [(7, f"<div>{draw.choice('abc')}</div><p>{number}</p>" + "<i>x</i>" * (number % 2)) for number in range(64)]
    trees = {row.host: {node["path"]: node for node in row.nodes} for row in learn(spark.createDataFrame(pages, "host long, html string")).collect()}
    root, div, p = (trees[7][path] for path in (0, _hash(0, "div", "", ""), _hash(0, "p", "", "")))
    counts = [sum(html.startswith(f"<div>{letter}") for _, html in pages) for letter in "abc"]
    assert isclose(div["content"], 1 - sum(n * log(n) for n in counts) / 64 / log(64))
    assert isclose(p["content"], 1) and isclose(div["presentation"], 0, abs_tol=1e-9)
    assert isclose(root["presentation"], log(2) / log(64))


def test_nulls_repeats_and_empty_tables(spark):
    html, text = page(3, "d.example", random.Random(2))
    rows = [(1, None, html), (None, "http://d.example", html), (2, "http://d.example", None), (2, "nonsense", ""), (3, "http://d.example", "plain")]
    found = [(row.page_id, row.url, row.text) for row in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(found, key=str) == sorted([(1, None, text), (None, "http://d.example", text), (2, "http://d.example", ""), (2, "nonsense", ""), (3, "http://d.example", "plain")], key=str)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_very_long_page():
    html = "<article>" + "<p>word</p>" * 50_000 + "</article><footer>f</footer>"
    assert Tree(html).text({}) == "\n".join(["word"] * 50_000)


def extracted(spark, pages, host="e.example"):
    rows = [(n, f"http://{host}/{n}", html) for n, html in enumerate(pages)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).collect()
    return {row.page_id: row.text.split("\n") for row in found}


def test_boilerplate_inside_the_article_goes(spark):
    # One line has a path of its own, one stands among the paragraphs.
    pages = [
        f"<article><h1>T {n}</h1><p>one {n}</p><p>two {n}</p><p>Follow our channel</p><div>Written by the desk</div></article><p>low</p>"
        for n in range(40)
    ]
    assert extracted(spark, pages) == {n: [f"T {n}", f"one {n}", f"two {n}"] for n in range(40)}


def test_text_beside_a_teaser_stays(spark):
    pages = [f"<article>Teaser {n}</article><div class='story'><p>one {n}</p><p>two {n}</p></div><div class='low'>All rights</div>" for n in range(40)]
    assert extracted(spark, pages) == {n: [f"Teaser {n}", f"one {n}", f"two {n}"] for n in range(40)}


def test_names_of_layout_wrappers_and_parts_of_names_do_not_count(spark):
    wrappers = ["class='site has-sidebar'", "id='content-with-sidebar'", "class='page header-fixed'", "class='sidebar'", "class='header'"]
    inner = "<section id='related-work'><p>r {n}</p></section><div class='hidden-xs'>h {n}</div><p class='notice-period'>p {n}</p>"
    kept = ["one {n}", "r {n}", "h {n}", "p {n}"]
    for outer in (f"<article><p>one {{n}}</p>{inner}</article>", f"<div><p>one {{n}}</p>{inner}</div>"):
        pages = [f"<div {wrappers[n % 5]}>{outer.format(n=n)}<div class='site-footer'>Imprint {n}</div></div>" for n in range(40)]
        assert extracted(spark, pages) == {n: [text.format(n=n) for text in kept] for n in range(40)}


def test_importance_overrules_names_inside_the_article(spark):
    pages = [f"<article><p>one two three {n}</p><div class='notice'>Note {n}</div><div class='share'>Share</div></article>" for n in range(40)]
    assert extracted(spark, pages) == {n: [f"one two three {n}", f"Note {n}"] for n in range(40)}


def test_names_outside_still_count():
    html = "<article><p>one two three four</p></article><div class='sidebar'><article>teaser</article></div><div class='post__comments'>c</div>"
    assert Tree(html).text({}) == "one two three four"
