import random

import pytest

from cohortloom.llm.spam import Page, learned_words, page_features, spam_pages

PROSE = "The effect of heat was visible only when the batch was kept in the model. After filtering, most of the reads were kept for the analysis. We compared the lots with each other, and none of them stood out. "
SPAM = {
    "repeated": "buy rna kit! " * 30,
    "shuffled": "cheap kit rna buy kit online cheap rna price kit buy price online rna kit cheap buy online price rna " * 3,
    "links": "\n".join(f'<a href="https://shop{i}.example/p{i}">cheap rna kit</a>' for i in range(12)),
    "markdown": " | ".join(f"[cheap kit](https://a.example/p-{i})" for i in range(12)),
    "brackets": " ".join(f"[url=https://a.example/p-{i}]sequencing price[/url]" for i in range(12)),
    "addresses": "\n".join(f"* shop{i}.example/item_{i}/go{i}" for i in range(12)),
    "tags": "Tags: " + ", ".join(["liver kit", "rna free", "cheap pcr", "skin fastq", "root primer", "gene sale"] * 4),
    "products": "\n".join(f"Rna Kit SKU-{i}{i} €{i}9.99 in stock buy now" for i in range(12)),
    "places": " • ".join(f"sequencing price {p}" for p in ["Ostrel", "Quelda", "Nyvale", "Lirrin"] * 4),
    "stuffed": "Our gene expression test is the best gene expression test for gene expression test buyers. Compare gene expression test with gene expression test. " * 5,
    "hidden": "ch​eap r​na ki​t, " * 30,
    "chinese": "测序 价格 基因检测 在线 测序 价格 引物 订购 " * 8,
    "with a lead": PROSE[:75] + "\n\n" + "buy rna kit! " * 40,
}
HONEST = {
    "prose": PROSE * 3,
    "footer": PROSE * 3 + "\n\nTags: leaf, retina, liver\nhttps://a.example/p1",
    "table": "run_accession\tcondition\tbatch\tmd5\n" + "\n".join(f"RUN{i}\ttreated\tb0{i}\t{'ab12' * 8}" for i in range(20)),
    "manifest": "run_accession,condition,batch,fastq,md5\n" + "\n".join(f"RUN{i},treated,b0{i},ftp://a.example/fq/RUN{i}_1.fastq.gz,{'cd34' * 8}" for i in range(20)),
    "log": "\n".join(f"2024-05-05 03:50:{i:02d} INFO trimming waiting for RUN588296" for i in range(30)),
    "genes": "\n".join("AXON_GUIDANCE_%d\tcurated\t" % i + "\t".join(f"Gxd{j}" for j in range(12)) for i in range(8)),
    "reading list": "\n".join(f"- {PROSE.strip()} See https://a.example/p{i}" for i in range(5)),
    "german": "Die Prüfsumme der zweiten Datei stimmte nicht, deshalb wurde sie erneut geladen. Für ovary fanden wir keine Änderung. " * 4,
    "chinese prose": "过滤后保留了93%的读段，去除批次效应后再计算相关系数。第二个文件的校验和不一致，因此重新下载。" * 4,
    "one gene": "Antibodies against Gxe5 gave a weak band at 5 kDa. Gxe5 is expressed in skin of salmon. We could not see Gxe5 in liver, whatever the batch. Loss of Gxe5 slows wound closure under drought. " * 3,
    "short": "buy kit",
    "empty": "",
    "null": None,
    "blank": " \n\t ",
}


def judged(spark, cases):
    rows = [(i, t, lang, "clash") for i, (t, lang) in enumerate(cases)]
    return {r.doc_id for r in spam_pages(spark.createDataFrame(rows, "doc_id long, text string, lang string, spam string")).collect()}


@pytest.mark.parametrize("lang", ["en", None, "UND"])
def test_cases(spark, lang):
    names = [*SPAM, *HONEST]
    got = judged(spark, [({**SPAM, **HONEST}[n], lang) for n in names])
    assert {names[i] for i in got} == set(SPAM)


def test_long_text_and_empty_table(spark):
    assert judged(spark, [("buy rna kit! " * 20_000, "en"), (PROSE * 1000, "en")]) == {0}
    assert judged(spark, []) == set()


def test_repeated_rows_and_figures(spark):
    df = spark.createDataFrame([(1, SPAM["links"], "en"), (1, SPAM["links"], "en")], "doc_id long, text string, lang string")
    rows = page_features(df).collect()
    assert len(rows) == 2 and all(r.spam and r.links == 12 and r.link > 0.9 for r in rows)
    assert Page(None).figures()["size"] == 0


# Sentences of ordinary prose, from which paragraphs are drawn.
SENTENCES = {
    "ru": "Утром мы вышли из дома и пошли к реке, потому что погода была хорошая. В старом саду росли яблони, и дети собирали плоды в корзины. Мой брат работает на заводе, а сестра учится в университете. Когда начался дождь, все люди побежали под крышу магазина. Я долго думал о том, что он сказал мне вчера вечером. На столе лежала книга, которую никто не открывал уже много лет. Если завтра будет тепло, мы поедем на озеро с друзьями. Учёные проверили данные ещё раз и не нашли в них ошибок. Она не знала, как ответить на этот вопрос, и молчала. После ужина отец читал газету, а мы играли в шахматы. В нашем городе есть театр, в котором идут новые спектакли. Он вернулся домой поздно, но на кухне ещё горел свет.",
    "ko": "아침에 일어나서 창문을 열어 보니 밖에 눈이 내리고 있었다. 우리는 기차를 타고 바다가 보이는 작은 마을로 갔다. 그 책은 오래전에 나온 것이지만 지금도 많은 사람이 읽고 있다. 할머니는 부엌에서 저녁을 준비하고 계셨고 아이들은 마당에서 놀았다. 연구자들은 결과를 다시 확인하기 위해 새로운 실험을 했다. 나는 그 사람이 왜 그런 말을 했는지 아직도 잘 모르겠다. 비가 그친 뒤에 하늘이 맑아지고 산이 가까이 보였다. 도서관은 오전 아홉 시에 문을 열고 저녁 여섯 시에 닫는다. 동생은 학교에서 돌아오는 길에 친구를 만나 이야기를 나누었다. 이 도시에는 오래된 건물이 많고 골목마다 작은 가게가 있다. 어제 회의에서 결정한 내용은 다음 주에 모두에게 알릴 것이다. 그는 커피를 마시면서 신문을 읽는 것을 좋아한다.",
    "pl": "Rano wyszliśmy z domu i poszliśmy nad rzekę, bo pogoda była ładna. W starym ogrodzie rosły jabłonie, a dzieci zbierały owoce do koszy. Mój brat pracuje w fabryce, a siostra studiuje na uniwersytecie. Kiedy zaczął padać deszcz, wszyscy ludzie pobiegli pod dach sklepu. Długo myślałem o tym, co powiedział mi wczoraj wieczorem. Na stole leżała książka, której nikt nie otwierał od wielu lat. Jeśli jutro będzie ciepło, pojedziemy nad jezioro z przyjaciółmi. Naukowcy sprawdzili dane jeszcze raz i nie znaleźli w nich błędów. Nie wiedziała, jak odpowiedzieć na to pytanie, więc milczała. Po kolacji ojciec czytał gazetę, a my graliśmy w szachy. W naszym mieście jest teatr, w którym grają nowe sztuki. Wrócił do domu późno, ale w kuchni jeszcze paliło się światło.",
    "it": "La mattina siamo usciti di casa e siamo andati al fiume, perché il tempo era bello. Nel vecchio giardino crescevano i meli e i bambini raccoglievano i frutti nei cesti. Mio fratello lavora in fabbrica, mentre mia sorella studia all'università. Quando è cominciata la pioggia, tutti sono corsi sotto il tetto del negozio. Ho pensato a lungo a quello che mi aveva detto ieri sera. Sul tavolo c'era un libro che nessuno apriva da molti anni. Se domani farà caldo, andremo al lago con gli amici. Gli studiosi hanno controllato i dati ancora una volta e non hanno trovato errori. Lei non sapeva come rispondere a quella domanda e taceva. Dopo cena il padre leggeva il giornale e noi giocavamo a scacchi. Nella nostra città c'è un teatro in cui si danno nuovi spettacoli. È tornato a casa tardi, ma in cucina la luce era ancora accesa.",
}


def paragraphs(lang, n=30, joint=" "):
    rng = random.Random(lang)
    own = [s.strip(" .") + "." for s in SENTENCES[lang].split(". ")]
    return [joint.join(rng.sample(own, rng.randint(3, 6))) for _ in range(n)]


STUFFED = {"ru": "купить набор рнк дешево ", "ko": "유전자 검사 가격 구매 ", "pl": "tani zestaw rna kup ", "it": "kit rna prezzo acquista "}


@pytest.mark.parametrize("joint", [" ", "\n"])
def test_prose_of_other_languages(spark, joint):
    prose = [(t, claim) for lang in SENTENCES for t in paragraphs(lang, joint=joint) for claim in (lang, None)]
    spam = [(STUFFED[lang] * 30, claim) for lang in SENTENCES for claim in (lang, None)]
    assert judged(spark, prose + spam) == set(range(len(prose), len(prose) + len(spam)))
    assert judged(spark, [p for p in prose if p[1]]) == set()


def test_a_table_in_two_parts_gives_the_same(spark):
    rows = [(t, lang) for lang in SENTENCES for t in paragraphs(lang)] + [(t, "en") for t in [*SPAM.values(), *HONEST.values()] * 2]
    whole = judged(spark, rows)
    parts = [judged(spark, rows[i::2]) for i in (0, 1)]
    assert whole == {2 * i + k for k in (0, 1) for i in parts[k]}


def test_words_are_learned_from_what_most_documents_share(spark):
    df = spark.createDataFrame([(i, t, "ru") for i, t in enumerate(paragraphs("ru"))] + [(99, PROSE, "en")], "doc_id long, text string, lang string")
    words = learned_words(df)
    assert set(words) == {"ru"} and {"и", "в", "на", "не"} <= words["ru"] and len(words["ru"]) < 150
    assert learned_words(df.limit(0)) == {}
    assert set(learned_words(df.selectExpr("doc_id", "text", "null as lang"))) == {"other-script"}


def test_more_languages_than_a_broadcast_takes(spark, monkeypatch):
    from cohortloom.llm import spam as module

    rows = [(t, lang) for t in [*SPAM.values(), *HONEST.values()] for lang in ("en", "fr")]
    want = judged(spark, rows)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    assert judged(spark, rows) == want


def test_rare_languages_are_learned_too(spark):
    tags = ", ".join(f"{a}{b}" for a in ("zestaw", "tani", "gen", "próbka", "odczyn") for b in ("y", "ami", "owe", "ów", "em", "ach"))
    rows = [(t, "pl") for t in paragraphs("pl", 14)] + [(tags, "pl")]
    many = rows + [("buy kit", "en")] * (1001 * len(rows))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(many)], "doc_id long, text string, lang string").repartition(4)
    assert learned_words(df)["pl"] == learned_words(df.where("lang = 'pl'"))["pl"] and "w" in learned_words(df)["pl"]
    assert judged(spark, many) == judged(spark, rows) == {len(rows) - 1}


@pytest.mark.parametrize("languages, words", [(1, 10**6), (3, 10**6), (10, 0)])
def test_more_learned_words_than_a_broadcast_takes(spark, monkeypatch, languages, words):
    from cohortloom.llm import spam as module

    rows = [(t, claim) for lang in SENTENCES for t in paragraphs(lang, 12) for claim in (lang, None)] + [(STUFFED[lang] * 30, lang) for lang in SENTENCES] + [(PROSE, "xx"), (None, "yy"), (SPAM["tags"], "zz")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    want = sorted(map(tuple, page_features(df).collect()))
    monkeypatch.setattr(module, "BROADCAST_LANGUAGES", languages)
    monkeypatch.setattr(module, "BROADCAST_WORDS", words)
    common, whole = module.common_languages(module.learned_table(df))
    assert common[0] == "other-script" and not whole
    assert sorted(map(tuple, page_features(df).collect())) == want
