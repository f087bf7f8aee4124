import json

from pyspark.sql import functions as F

from scriptorium import annotate, corpus
from scriptorium.operators import catalogue, containers, entities, language, losses, notes, offsets, order, sentences, spans, validate
from scriptorium.functions import labels
from scriptorium.sources import alto, catalogues, sinks, tei
from scriptorium.streaming import ingest

PAGE = """<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Tags><OtherTag ID="T1" LABEL="MainZone:column#1"/><OtherTag ID="T2" LABEL="default"/><OtherTag ID="T3"/></Tags>
<Layout><Page WIDTH="100" HEIGHT="200"><PrintSpace><TextBlock ID="B1" TAGREFS="T1" HPOS="1" VPOS="2" WIDTH="3" HEIGHT="4">
<Shape><Polygon POINTS="1 2 3 4"/></Shape><TextLine ID="L1" TAGREFS="T2" BASELINE="1 2 3 4" HPOS="1" VPOS="2" WIDTH="3" HEIGHT="1"><String CONTENT="Le"/><SP/><String CONTENT="roy{0}"/><String CONTENT="!"/></TextLine>
<TextLine ID="L2"><String CONTENT=""/></TextLine></TextBlock></PrintSpace></Page></Layout></alto>"""


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_page_files(spark, tmp_path):
    folder = tmp_path / "corpus" / "VOL1"
    folder.mkdir(parents=True)
    (folder / "f2.xml").write_text(PAGE.format(""))
    (folder / "f3.xml").write_text(PAGE.format(" & fils"))
    (folder / "f4.xml").write_text("<alto><broken")
    pages = alto.pages(spark, str(tmp_path / "corpus")).cache()
    found = {r["stem"]: r for r in pages.collect()}
    assert found["f2"]["doc"] == "VOL1" and found["f2"]["width"] == 100 and found["f2"]["warning"] is None
    assert found["f3"]["warning"].startswith("mended") and found["f4"]["error"]
    lines = {(r["stem"], r["line_id"]): r for r in alto.lines(pages).collect()}
    assert lines["f2", "L1"]["text"] == "Le roy!" and lines["f3", "L1"]["text"] == "Le roy & fils!" and lines["f2", "L2"]["text"] == ""
    assert lines["f2", "L1"]["zone_label"] == "MainZone:column#1" and lines["f2", "L1"]["line_label"] == "default"
    assert rows(alto.zones(pages).filter("stem = 'f2'").select("zone_id", "points", "w")) == [("B1", "1 2 3 4", 3.0)]
    ordered = order.page_order(pages.select("doc", "stem", "path"), ["doc"], "stem", "path")
    assert rows(ordered.orderBy("page_ord").select("stem", "num")) == [("f2", 2), ("f3", 3), ("f4", 4)]


def test_catalogues(spark, tmp_path):
    (tmp_path / "p.csv").write_text("BDD;Nom\nP1;old\nP2; nan \nP1;new\n")
    assert sorted(rows(catalogues.persons(spark, str(tmp_path / "p.csv")).select("BDD", "Nom"))) == [("P1", "new"), ("P2", None)]
    (tmp_path / "m.csv").write_text("http://a/1,x,f1.xml\nhttp://a/2,x,f2\n")
    images = catalogues.image_map(spark, str(tmp_path / "m.csv"))
    pages = spark.createDataFrame([("f1",), ("f2.xml",), ("f9",)], "page string")
    assert sorted(rows(catalogue.image_of(pages, "page", images, "file", "url"))) == [("f1", "http://a/1"), ("f2.xml", "http://a/2"), ("f9", None)]
    assert catalogues.map_fit(images, pages, "page").first()["accepted"] is True


def test_prefix_match(spark):
    prefixes = spark.createDataFrame([("LIV1",), ("LIV9",)], "prefix string")
    books = spark.createDataFrame([("LIV12", 0), ("LIV1", 1), ("X", 2)], "bdd string, ord int")
    assert sorted(rows(catalogue.prefix_match(prefixes, "prefix", books, "bdd", "ord"))) == [("LIV1", 2, "LIV1", 1), ("LIV9", 0, None, None)]


def test_containers_and_fronts(spark):
    zones = spark.createDataFrame([("d", 1, "TitlePageZone"), ("d", 2, "TitlePageZone"), ("d", 2, "MainZone"), ("d", 3, "MainZone")], "doc string, page_ord int, zone_type string")
    fronts = containers.front_pages(zones, ["doc", "page_ord"], "zone_type")
    assert rows(fronts) == [("d", 1)]
    lines = spark.createDataFrame(
        [("d", 1, 1, "t", "TitlePageZone", "DefaultLine"), ("d", 2, 2, "a", "MainZone", "HeadingLine"), ("d", 2, 3, "a", "MainZone", "DefaultLine"), ("d", 2, 4, "n", "MarginTextZone", "DefaultLine"), ("d", 2, 5, "a", "MainZone", "DefaultLine"), ("d", 3, 6, "h", "RunningTitleZone", "DefaultLine")],
        "doc string, page_ord int, line_ord int, zone_id string, zone_type string, line_type string",
    )
    found = containers.containers(lines, fronts).orderBy("line_ord").select("kind", "cont_ord", "page_break", "div_ord").collect()
    assert [r["kind"] for r in found] == ["titlePart", "head", "ab", "note", "ab", "fw"]
    assert len({r["cont_ord"] for r in found}) == 6 and [r["page_break"] for r in found] == [True, True, False, False, False, True] and found[-1]["div_ord"] == 1


def test_notes_face_lines(spark):
    lines = spark.createDataFrame([("p", "l1", 0.0, 10.0, "a"), ("p", "l2", 10.0, 20.0, "b *"), ("p", "l3", 30.0, 40.0, "c")], "page string, line_id string, top double, foot double, text string")
    found = notes.note_links(spark.createDataFrame([("p", "n1", 5.0, 25.0, "x"), ("p", "n2", 5.0, 25.0, "* y"), ("p", "n3", 50.0, 60.0, "z"), ("p", "n4", 1.0, 2.0, "v")], "page string, note_id string, top double, foot double, text string"), lines, ["page"])
    got = {r["note_id"]: (r["anchor"], r["targets"], r["n"]) for r in found.collect()}
    assert got == {"n1": ("l1", ["l1", "l2"], 2), "n2": ("l2", ["l1", "l2"], None), "n3": (None, None, None), "n4": ("l1", ["l1"], 1)}


def test_language_volume_and_usage(spark):
    own = spark.createDataFrame([("d", 1, "fra", 160), ("d", 2, "fra", 10)], "doc string, cont int, lang string, words long")
    foreign = spark.createDataFrame([("d", 1, "lat", 1), ("d", 2, "lat", 12)], "doc string, cont int, lang string, words long")
    volumes = language.language_volume(own, foreign, ["doc"])
    assert dict(rows(volumes.select("lang", "words"))) == {"fra": 159, "lat": 13}
    tiny = spark.createDataFrame([("d", "fra", 999), ("d", "lat", 1)], "doc string, lang string, words long")
    assert dict(rows(language.usage(tiny, ["doc"]).select("lang", "share"))) == {"fra": 100, "lat": 1}


def test_sentences(spark):
    text = "Voici M . Dupont . Il vient : Oui ! non"
    tokens = spark.createDataFrame([("c", k, w) for k, w in enumerate(text.split())], "cont string, tok_ord int, form string")
    found = sentences.segmented(tokens, ["cont"]).groupBy("sent_ord").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("tok_ord", "form"))), lambda s: s["form"])).alias("s"))
    assert [r["s"] for r in found.orderBy("sent_ord").collect()] == ["Voici M . Dupont .", "Il vient :", "Oui ! non"]


def test_word_windows(spark):
    docs = spark.createDataFrame([(1, "a " * 5), (2, "a " * 12), (3, "")], "id int, text string")
    found = spans.word_windows(docs, ["id"], F.size(F.filter(F.split("text", " "), lambda w: w != "")), 5, 2)
    assert sorted(rows(found.select("id", "first", "last"))) == [(1, 0, 5), (2, 0, 5), (2, 3, 8), (2, 6, 11), (2, 9, 12), (3, 0, 0)]


def test_entities(spark):
    assert spark.range(1).select(entities.unrepeated(F.lit("Jean Roy Jean Roy"))).first()[0] == "Jean Roy"
    names = spark.createDataFrame([("PER", "dupont", 0, 1), ("PER", "dupond", 1, 5), ("PER", "martin", 2, 1), ("LOC", "dupont", 3, 1)], "type string, name string, ord int, mentions int")
    merged = {(r["type"], r["name"]): r["representative"] for r in entities.fuzzy_merged(names, ["type"], "name", "ord", "mentions").collect()}
    assert merged == {("PER", "dupont"): "dupond", ("PER", "dupond"): "dupond", ("PER", "martin"): "martin", ("LOC", "dupont"): "dupont"}


def test_losses(spark):
    lost = spark.createDataFrame([("LINE_LOST", 2, 1, 3), ("WORD_MENDED", 5, 2, 3), ("PAGE_LOST", 0, 3, 3)], "code string, count int, ord int, block int")
    assert rows(losses.by_block(lost, "block", "code", "count", ["WORD_MENDED"])) == [(3, 2, 5, 3)]
    assert rows(losses.gate(lost, "code", "count", "ord", ~F.col("code").isin("WORD_MENDED"))) == [("LINE_LOST", 1, 2)]
    docs = spark.createDataFrame([("a", 1, 4), ("b", 1, 3), ("c", 0, 0)], "doc string, lost int, total int")
    assert rows(losses.page_loss(docs, "lost", "total", 25).select("doc")) == [("b",)]


def test_run_records(spark):
    lines = [json.dumps({"code": "A", "document": "d", "count": 3}), "{bad", json.dumps({"code": "B"})]
    found = catalogues.read_incidents(spark.createDataFrame(list(enumerate(lines)), "ord long, value string")).orderBy("ord")
    assert rows(found.select("incident", "code", "count")) == [("I1", "A", "3"), (None, "unreadable", None), ("I2", "B", None)]


def test_validation(spark):
    elements = spark.createDataFrame([("d", 0, None, "text"), ("d", 1, 0, "ab"), ("d", 2, 1, "ab")], "doc string, ord int, parent_ord int, tag string")
    allowed = spark.createDataFrame([("text", "ab")], "parent string, tag string")
    wrong = validate.misplaced(elements, allowed)
    assert rows(wrong.select("ord")) == [(2,)]
    assert rows(validate.violations([("placement", "error", wrong), ("none", "error", wrong.limit(0))])) == [("placement", "error", 1)]


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("v1", "T & C", 1, "ab", "z1", 1, True, 1, "a < b"), ("v1", "T & C", 1, "ab", "z1", 1, False, 2, "c")], "doc string, title string, cont_ord int, kind string, zone_id string, page_ord int, page_break boolean, line_ord int, text string")
    made = sinks.tei(lines)
    xml = made.first()["xml"]
    root, warning = alto.parse_xml(xml.encode())
    assert warning is None and "a &lt; b" in xml and "T &amp; C" in xml
    assert rows(sinks.write_files(made, "doc", "xml", str(tmp_path))) == [("v1", len(xml.encode()))] and (tmp_path / "v1.xml").read_text() == xml
    sinks.write_entities(spark.createDataFrame([("v1", "PER", "e1", "Roy", 2)], "doc string, type string, entity_id string, canonical string, mentions int"), str(tmp_path / "e"))
    assert spark.read.option("sep", ";").option("header", "true").csv(str(tmp_path / "e")).count() == 1


def test_streaming_ingest(spark, tmp_path, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(spark, str(tmp_path / "in"), events.schema, lambda df, k: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination()
    assert sum(seen) == events.count()
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = ingest.windowed_counts(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == events.count()


def test_corpus(spark, tmp_path):
    folder = tmp_path / "c" / "LIV1"
    folder.mkdir(parents=True)
    (folder / "f2.xml").write_text(PAGE.format(""))
    (folder / "f3.xml").write_text("<alto><broken")
    (tmp_path / "books.csv").write_text("BDD;Titre\nLIV1;Un livre\n")
    c = corpus.Corpus(spark, str(tmp_path / "c"), str(tmp_path / "books.csv"))
    assert rows(c.extent()) == [("LIV1", 2, 1)] and rows(c.losses()) == [("LIV1", 1, 2)] and rows(c.failing(40).select("doc")) == [("LIV1",)]
    assert rows(c.zones().select("type", "subtype", "n", "lrx", "dup")) == [("MainZone", "column", "1", 4, 0)]
    assert rows(c.matched().select("doc_key", "Titre")) == [("LIV1", "Un livre")]
    assert "Le roy!" in c.tei().first()["xml"] and c.collisions().count() == 0
    c.register()
    assert spark.sql("SELECT count(*) FROM corpus_lines").first()[0] == 2


def test_annotators_count_what_they_miss(spark):
    class Failing:
        def annotate(self, texts):
            raise OSError("down")

    texts = spark.createDataFrame([(k, "Le roy." if k else " ") for k in range(6)], "id int, text string").coalesce(1)
    assert sorted(rows(annotate.annotated(texts, "text", Failing, batch=1, patience=2).groupBy("status").count())) == [("refused", 2), ("skipped", 1), ("unsent", 3)]
    tagged = annotate.annotated(texts, "text", annotate.RuleTagger).filter("id = 1").first()
    assert [t["pos"] for t in json.loads(tagged["annotation"])] == ["NOMpro", "NOMcom", "PONC"] and tagged["status"] == "ok"


def test_runs(spark):
    runs = spark.createDataFrame([("r1", corpus.manifest([], {}, {"a": "failed"}, 1)), ("r2", corpus.manifest([], {}, {"a": "ok", "b": "failed"}, 1))], "run string, value string")
    assert rows(corpus.failed(runs)) == [("b",)]
    assert corpus.kept_runs([f"r{k:02}" for k in range(13)], "r00") == ["r00"] + [f"r{k:02}" for k in range(3, 13)]


def test_cleaning_keeps_origins():
    text, origin = offsets.cleaned_with_origin("  iour  mot¬\n entier |ſi uuide auuoir")
    assert text == "jour motentier si uuide auvoir"
    assert len(origin) == len(text) and origin == sorted(origin)
    plain, places = offsets.cleaned_with_origin("un deux")
    assert plain == "un deux" and places == list(range(7))


def test_splicing_trims_to_words():
    text = "abc def ghi jkl"
    assert offsets.spliced_segments(text, [(0, 6, "a"), (4, 11, "b"), (5, 6, "c"), (12, 99, "d")]) == [(0, 6, "a"), (8, 11, "b"), (12, 15, "d")]


def test_spans_joined_over_hyphens(spark):
    r = spark.range(1).select(offsets.dehyphenated_spans(F.array(F.lit("le mo¬ "), F.lit(" nde est"), F.lit(" là"))).alias("r")).first()["r"]
    assert r["text"] == "le monde est là" and r["cuts"] == [5]


def test_tei_elements(spark):
    docs = spark.createDataFrame([("d", "<TEI xmlns='x'><text n='1'>a<ab/><ab xml:id='z'/></text></TEI>"), ("e", "<TEI")], "doc string, xml string")
    found = {(r["doc"], r["ord"]): r for r in tei.elements(docs).collect()}
    assert [found["d", k]["tag"] for k in range(4)] == ["TEI", "text", "ab", "ab"] and found["d", 3]["parent_ord"] == 1 and found["d", 3]["attrs"] == {"id": "z"} and found["d", 0]["parent_ord"] is None
    assert found["e", 0]["tag"] == "unreadable"


def test_small_label_functions(spark):
    r = spark.range(1).select(labels.language_ident(F.lit(" Latin")).alias("a"), labels.language_ident(F.lit("basque")).alias("b"), labels.version_prefix(F.lit("1.2.x")).alias("c"), labels.version_prefix(F.lit("x")).alias("d"), labels.locator(F.lit("PAGE"), F.lit("v"), F.lit("f2"), F.lit("p")).alias("e")).first()
    assert tuple(r) == ("lat", "und", "1.2", "0", "v/f2")
