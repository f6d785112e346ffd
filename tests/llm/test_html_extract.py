import itertools
import math

import pytest

from quarry.llm import html_extract as H


@pytest.fixture(scope="module")
def model(spark):
    return H.train(spark)


P = "<p>The quick brown fox jumps over the lazy dog and runs away into the forest. It was late.</p>"
TEXT = "The quick brown fox jumps over the lazy dog and runs away into the forest. It was late."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("Only text.", "Only text."),
    (f"<nav><ul><li><a href=/a>A</a></li></ul></nav><!-- x --><div class=ad>Buy it.</div><article><h1>Ti &amp; tle</h1>{P}<p>a<b>b</b>&nbsp; c<br>d &lt;e<p>end</article><footer>&copy; x</footer>",
     f"Ti & tle {TEXT} ab c d <e end"),
    (f"<header><h1>Site</h1></header><main>{P}</main><section id=comments><div class=comment><p>I agree with everything here.</p></div></section>", TEXT),
    (f"<div class=cookie-banner><p>We use cookies to improve your visit. By going on you agree.</p></div><div class=post><div>{P}</div></div>", TEXT),
    (f"<article>{P}<aside class=related><p>Read this other thing.</p></aside><script>var t='</p>x'</script><style>p{{}}</style></article><form><label>Name</label><p>We never share.</p></form>", TEXT),
    (f"<article>{P}<p>cut off in a tag <b", TEXT + " cut off in a tag"), (f"<article>{P}<p>open <!-- comment", TEXT + " open"),
])
def test_main_text(model, page, want):
    assert H.main_text(page, model) == want


@pytest.mark.parametrize("page, want", [
    (f'<article>{P}<p><svg class="icon"/>After it. <math/>And more.</p>{P}</article>', f"{TEXT} After it. And more. {TEXT}"),
    (f'<article>{P}<p><svg class=icon><path d="M0"/><style>p{{}}</style>{P}</article>', f"{TEXT} {TEXT}"),
    (f'<article>{P}<svg><title>t</title><style/><script/><g/></svg>{P}</article><footer><svg></svg>&copy; x</footer>', f"{TEXT} {TEXT}"),
    (f"<article>{P}<object data=x>{P}</article>", f"{TEXT} {TEXT}"), (f"<article>{P}<object data=x><p>Fallback text is here.</p></object>{P}</article>", f"{TEXT} Fallback text is here. {TEXT}"),
    (f"<article>{P}<select><option>A<option>B{P}{P}</article>", f"{TEXT} {TEXT} {TEXT}"),
    (f"<article>{P}<p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> at rest, as he said.</p></article>", f"{TEXT} The energy is E=m at rest, as he said."),
])
def test_elements_without_end_tags_and_foreign_elements_lose_no_text(model, page, want):
    got = H.main_text(page, model)
    assert got.replace(" A B ", " ") == want

N = "<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
END = "<footer>&copy; 2020 Someone. All rights.</footer>"
LINKS = "<ul><li><a href=/x>First link</a></li><li><a href=/y>Second link</a></li></ul>"
FOUND = "First link Second link"


@pytest.mark.parametrize("body, want", [
    (f"<article>{P * 4}{LINKS}</article>", [TEXT] * 4 + [FOUND]),
    (f"<article>{P}{LINKS}{P}{LINKS}{P}</article><section class=comments><div class=comment><p>I agree with it.</p></div></section>", [TEXT, FOUND, TEXT, FOUND, TEXT]),
    (f"<article>{P * 6}<p><a href=/z>A wholly linked paragraph here</a></p>{P * 6}</article>", [TEXT] * 6 + ["A wholly linked paragraph here"] + [TEXT] * 6),
    (f"<main><h1>A title</h1><h2><a href=/q>The section</a></h2>{P * 3}{LINKS}</main>", ["A title The section"] + [TEXT] * 3 + [FOUND]),
    (f"<article>{P * 4}<pre class=input>x = 1</pre>{P}</article>", [TEXT] * 4 + ["x = 1", TEXT]),
    (f"<article class=review>{P * 8}</article>", [TEXT] * 8), (f"<main><article class='review'>{P * 8}</article></main>", [TEXT] * 8),
    (f"<article>{P * 3}<blockquote class=top-quote>{P}</blockquote>{P}</article>", [TEXT] * 5),
    (f"<article>{P * 3}<section class=share-tips><h2>How to share</h2>{P}</section></article><aside><h3>More</h3>{LINKS}</aside>", [TEXT] * 3 + ["How to share", TEXT]),
    (f"<div id=content><h1>Contact</h1><div class=contact>{P * 2}</div></div>", ["Contact", TEXT, TEXT]),
    (f"<article>{P * 3}<aside class=related><h3>More</h3>{LINKS}</aside>{P}</article>", [TEXT] * 4),
    (f"<article>{P}<p hidden>Hidden words are here.</p><p style='display:none'>More are here.</p>{P}</article>", [TEXT, "Hidden words are here. More are here.", TEXT]),
    (f"<article>{P}<xmp><b>x</b> &amp;</xmp>{P}</article>", [TEXT, "<b>x</b> &amp;", TEXT]),
    ("<article><p>One two three.</ ><p>Four five six.</></article>", ["One two three. Four five six."]),
])
def test_layouts_written_by_hand(model, body, want):
    """Links, code, quotes and names that hint at something else, inside the article."""
    assert H.main_text(N + body + END, model) == " ".join(want)


def test_letters_that_grow_in_lower_case_shift_no_end_tag(model):
    for k in (1, 5, 12, 60):
        name = "\u0130" * k
        page = f"<article>{P}<p>{name} is where it was.</p><SCRIPT>var a = 1</Script>{P}<style>p</scripty></style>{P}</article>"
        assert H.main_text(page, model) == f"{TEXT} {name} is where it was. {TEXT} {TEXT}"


def test_sum_product_gives_the_exact_marginals(model):
    for seed in range(30):
        page = H._Pages(seed)
        tree = H.parse(f"<div class=post>{page.words(1, 3)}<p>{page.words(1, 9)}</p></div>{page.one_of('<nav><a>x</a></nav>', '<ul><li>y</ul>')}")
        n = len(tree.parent)
        total, sums = 0.0, [[0.0] * 3 for _ in range(n)]
        for labels in itertools.product(range(3), repeat=n):
            if any(y == 2 and t is not None for y, t in zip(labels, tree.text, strict=True)):
                continue
            weight = model.root[labels[0]]
            for i in range(n):
                for s in tree.signs[i]:
                    weight *= math.exp(model.sign.get((H._kind(tree, i), s), (0, 0, 0))[labels[i]])
                if i:
                    weight *= model.edge_of(tree, i)[labels[tree.parent[i]]][labels[i]]
            total += weight
            for i, y in enumerate(labels):
                sums[i][y] += weight
        for got, want in zip(H.marginals(tree, model), sums, strict=True):
            assert got == pytest.approx([x / total for x in want], abs=1e-9)


def test_held_out_labelled_pages(model):
    right = runs = 0
    for i in range(200):
        tree, labels = H.labelled(H._Pages(10 ** 9 + i).page())
        for text, label, belief in zip(tree.text, labels, H.marginals(tree, model), strict=True):
            if text is not None:
                runs += 1
                right += (belief[H.CONTENT] > 0.5) == (label == H.CONTENT)
    assert right / runs > 0.95


def test_odd_pages_do_not_break(model):
    deep = "<div>" * 5000 + "x y z." + "</div>" * 5000
    for page in (deep, "<" * 5000, "<p" * 3000, "&" * 5000, "</p></div></b>" * 50, "<a title=it's>b</a> c.", '<p class="x>y', "<table><tr><td>a<td>b<tr><td>c</table>", "\x00\ud7ff"):
        assert isinstance(H.main_text(page, model), str)


def test_operator(model, frame):
    rows = [(1, "u", f"<article>{P}</article>"), (1, "u", f"<article>{P}</article>"), (None, None, None), (2, "u", "<nav><a>x</a></nav>")]
    df = frame("page_id long, url string, html string", rows)
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in H.extract(df, model).collect())
    assert got == [(0, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert H.extract(df.limit(0), model).count() == 0
