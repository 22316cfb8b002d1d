"""What repeats is judged by its share of the pages, and frames of pages are no forms."""

import pytest

from changelake.llm.site_tree import extract


def texts(spark, pages):
    df = spark.createDataFrame([(n, "http://h/x", html) for n, html in enumerate(pages)], "page_id long, url string, html string")
    return {row.page_id: row.text for row in extract(df.repartition(8)).collect()}


def page(n, quoted):
    quote = "<p>A sentence that many articles quote word by word.</p>" if quoted else ""
    return f"<body><nav>menu</nav><article><h1>Title {n}</h1><p>First {n} of its own.</p>{quote}<p>Last {n} words.</p></article><footer>foot</footer></body>"


@pytest.mark.parametrize("size", [100, 500, 5000])
def test_a_text_on_a_third_of_the_pages_stays_at_every_size(spark, size):
    found = texts(spark, [page(n, n % 20 < 7) for n in range(size)])
    assert sum("many articles quote" in text for text in found.values()) == sum(n % 20 < 7 for n in range(size))
    assert all(text.startswith(f"Title {n}\nFirst {n} of its own.") and text.endswith(f"Last {n} words.") for n, text in found.items())


def test_pages_within_a_form_or_shown_by_a_script_keep_their_text(spark):
    def body(n):
        return f"<nav>menu</nav><p>A long paragraph of text that makes up page {n}.</p><p>And {n} more of them.</p>"

    frames = [f"<body><form action='x'>{body(0)}<input name='q'></form></body>", f"<body style='display: none'>{body(1)}</body>", f"<body>{body(2)}<form><p>Your name</p></form></body>"]
    found = texts(spark, frames)
    assert found == {n: f"A long paragraph of text that makes up page {n}.\nAnd {n} more of them." for n in range(3)}


def test_formulas_and_buttons_within_a_text_stay(spark):
    text = "<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> indeed.</p><p>Press <button>Start</button> now.</p><button>Share</button></article>"
    assert texts(spark, [f"<body>{text}</body>"])[0] == "Energy is E=m indeed.\nPress Start now."
