import html
import random
import re
import time

from fixtures import clashing, documents

from eventide.llm import language

EN = "the cat and the dog sat with that thing on the mat in this house "
DE = "der hund und die katze sitzen nicht mit dem ding auf der matte im haus "


def labelled(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 4), "en" if i % 2 else "de", f"src{i % 3}", 0) for i in range(40)]
    rows += [(100, None, "en", "s", 0), (101, "x", None, "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_held_out_and_rejected(spark):
    model = language.train(labelled(spark))
    assert model.languages == ["de", "en"]
    texts = ["that cat in the house", "die katze im haus", "12 %% 34", None, ""]
    found = {r.id: r for r in language.identify(clashing(documents(spark, texts).drop("id")), model, "doc_id", "text").collect()}
    assert [found[i].lang for i in (0, 1)] == ["en", "de"]
    assert [found[i].rejected for i in range(5)] == [False, False, True, True, True]


def test_other_evidence_decides_short_texts(spark):
    model = language.train(labelled(spark))
    rows = [(i, EN, "en", "http://a.example.de/x") for i in range(30)] + [(i + 30, DE, "de", "http://b.example.de/x") for i in range(30)]
    rows += [(90, "qq", "de", "http://b.example.de/y"), (91, "qq", "en", "http://a.example.de/y"), (92, None, None, None)]
    pages = spark.createDataFrame([(i, f'<html lang="{d}"><style>x</style><p>{t or ""}</p></html>' if d else None, u)
                                   for i, t, d, u in rows], "page_id long, html string, url string")
    found = {r.id: r for r in language.identify_pages(pages, model).collect()}
    assert found[90].lang == "de" and found[91].lang == "en" and found[92].rejected
    assert len(found) == 63


def test_nothing_to_learn_from(spark):
    model = language.train(documents(spark, []))
    found = language.identify(documents(spark, ["some text"]), model, "doc_id", "text").collect()
    assert [(r.lang, r.rejected) for r in found] == [(None, True)]
    model = language.train(labelled(spark))
    assert language.identify(documents(spark, []), model, "doc_id", "text", "lang", "source").collect() == []


def test_bounded_sample_ignores_the_rest(spark):
    few = language.train(labelled(spark), per_language=3)
    assert few.languages == ["de", "en"]


UNKNOWN = ["Это простой русский текст о погоде и о том, как живут люди", "这是一个关于天气和城市生活的简单中文文本",
           " ".join("xqzvkjwpbfgmyc"[i % 7:i % 5 + 8] + "zqxjkvw"[i % 4:i % 3 + 4] for i in range(200))]
CLEAN = ["the dog", "hund und katze", EN, DE, EN * 500, "the dog sat in the house with the cat"]


def test_texts_in_no_known_language_go(spark):
    texts = CLEAN + UNKNOWN + [t * 50 for t in UNKNOWN]
    found = {r.id: r for r in language.identify(
        documents(spark, texts), language.train(labelled(spark)), "doc_id", "text", "lang", "source").collect()}
    assert [i for i in range(len(texts)) if not found[i].rejected] == list(range(len(CLEAN)))
    one = language.train(labelled(spark).where("lang = 'en'"))
    found = {r.id: r for r in language.identify(documents(spark, [EN, *UNKNOWN]), one, "doc_id", "text").collect()}
    assert [found[i].rejected for i in range(4)] == [False, True, True, True]


def test_labelled_noise_does_not_vouch_for_itself(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 4), "en" if i % 2 else "de", "s", 0) for i in range(400)]
    rows += [(1000 + i, t * 20, "en", "s", 0) for i, t in enumerate(UNKNOWN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = language.identify(docs, language.train(docs), "doc_id", "text", "lang", "source", label_col="lang")
    assert {r.id for r in found.where("rejected").collect()} == {1000, 1001, 1002}


def test_visible_text_in_linear_time():
    """As a regular expression would have it, on markup of all kinds and on markup that is never closed."""
    hidden = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    rng = random.Random(3)
    parts = ["<", "<!--", "-->", "<script", "<SCRIPT>", "</script>", "</Script >", "<style>", "</style>", ">", "a", " ", "&amp;",
             "&#65;", "&#00000065;", "<p>", "</", "<scripts>", "\u00e9", "\n", "<!-->"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert language.visible_text(text.encode()).decode() == html.unescape(hidden.sub(" ", text))
    start = time.perf_counter()
    for piece in ("<!--", "<script", "<", "<style>x", "<!-- >", "&#1", "<script></scrip>"):
        language.visible_text((piece * 300_000).encode())
    assert time.perf_counter() - start < 20
