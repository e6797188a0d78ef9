from pyspark.sql import functions as F

from podium.sources import formats as S
from podium.sources import store
from podium.streaming.totals import speaker_totals

SF = "/root/testdata/sf0.001"


def test_vtt(spark, tmp_path):
    text = "WEBVTT\n\n1\n00:01.500 --> 1:00:02,250 align:start\n<v Ann>Hello\nthere</v>\n\nNOTE x\n\n00:00:05.000 --> bad\nno\n\n00:00:07.000 --> 00:00:08.000\n\n00:00:01.000 --> 00:00:02.000\n00:00:09.000 --> 00:00:10.000\nlast wins\n"
    (tmp_path / "a.vtt").write_text(text)
    (tmp_path / "b.vtt").write_text("<html>00:00:09.000 --> 00:00:10.000\nx")
    rows = S.read_vtt(spark, str(tmp_path / "*.vtt")).orderBy("block").collect()
    assert [(r.start_ms, r.end_ms, r.text) for r in rows] == [(1500, 3602250, "Hello there"), (9000, 10000, "last wins")]


def test_archive_and_pages(spark):
    html = '<a data-m4v="x/y.m4v" data-name=" A " data-hasagenda="TRUE" data-date="2024-01-02">q</a><a href="#">n</a><a data-m4v="">e</a><a class="k" data-m4v="https://h/z.m4v" data-name=\'O "B"\'>r</a>'
    rows = S.archive_listing(spark.createDataFrame([(html,)], "h string"), "h", "https://m/").orderBy("place").collect()
    assert [(r.name, r.video_url, r.vtt_url, r.has_agenda) for r in rows] == [("A", "https://m/x/y.m4v", "https://m/x/y.vtt", True), ('O "B"', "https://h/z.m4v", "https://h/z.vtt", False)]
    df = spark.createDataFrame([("<script>{m4v: 'v.m4v'}</script>" + html,), ("none",)], "h string")
    assert [r.v for r in df.select(S.page_video(F.col("h"), "https://m").alias("v")).collect()] == ["https://m/v.m4v", None]


def test_batch_urls_and_env(spark, tmp_path):
    df = spark.createDataFrame([("a.mp4",), ("# c",), ("  ",), ("b.mp4 2024-01-01 Here Special  Session ",)], "l string")
    assert [tuple(r) for r in S.batch_lines(df, "l", "C", "K").collect()] == [("a.mp4", "", "C", "K"), ("b.mp4", "2024-01-01", "Here", "Special  Session")]
    u = spark.createDataFrame([("https://m.x/1",), ("ftp://a/b",), ("/in/a",), (None,), ("http://arch.y/p?q",)], "u string")
    assert [tuple(r) for r in u.select(S.is_url(F.col("u")), S.route(F.col("u"), "m.x", "arch.y")).collect()] == [(True, "file"), (False, "as_is"), (False, "as_is"), (False, "as_is"), (True, "page")]
    assert S.env_lines(["# x", "A=1", 'B="2"', "A=3", "junk"]) == {"A": "1", "B": "2"}
    (tmp_path / "2024-05-06-x.MP4").write_bytes(b"1")
    (tmp_path / "n.txt").write_bytes(b"1")
    files = S.video_files(S.list_files(spark, str(tmp_path)), "path", "C", "K").collect()
    assert [r.date for r in files] == ["2024-05-06"]


def test_json(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"meeting_id": "m",\n "segments": [{"segment_id": 1, "words": [{"word": "a", "start": 0.0, "end": 1.0}]}]}')
    (tmp_path / "e.json").write_text('{"A": [1.0, 2.0], "B": []}')
    m = S.read_meetings(spark, str(tmp_path / "m.json")).collect()[0]
    assert m.segments[0].words[0].word == "a" and m.segments[0].text == "" and m.speakers == {} and m.summary is None and m.meeting_type == "Regular Session" and m.processing_metadata.pipeline_version == "1.0.0"
    assert {r.label: r.embedding for r in S.read_embeddings(spark, str(tmp_path / "e.json")).collect()} == {"A": [1.0, 2.0], "B": []}
    s = spark.createDataFrame([('{"segment_id": 3}',)], "j string").select(S.segment_from_json(F.col("j")).alias("s")).collect()[0].s
    assert s.text == "" and s.words == [] and s.speaker_name is None


def test_store_is_swapped(spark, tmp_path):
    path = str(tmp_path / "store")
    assert store.load_state(spark, path).count() == 0
    rows = [("m", 4, 0, 9), ("n", 1, 5, 9)]
    store.replace(spark.createDataFrame(rows, store._STATE), path)
    store.replace(store.load_state(spark, path).withColumn("completed_stage", F.col("completed_stage") + 1), path)
    assert sorted(r.completed_stage for r in store.load_state(spark, path).collect()) == [2, 5]
    assert [r.meeting_id for r in store.is_complete(store.load_state(spark, path), "identified").collect()] == ["m"]
    assert [p.name for p in tmp_path.iterdir()] == ["store"]
    before = store.load_state(spark, path)
    store.mark_complete(spark, path, spark.createDataFrame([("n",), ("new",)], "meeting_id string"), "exported")
    assert before.where("meeting_id = 'new'").count() == 0
    store.update_progress(spark, path, spark.createDataFrame([("m", 7, 8)], "meeting_id string, transcription_progress int, total_segments int"))
    assert sorted(tuple(r) for r in store.load_state(spark, path).collect()) == [("m", 5, 7, 8), ("n", 7, 5, 9), ("new", 7, 0, 0)]
    assert len(list((tmp_path / "store").glob("v-*"))) == 2


def test_samples_and_roots(spark, tmp_path):
    df = spark.createDataFrame([([float(i) for i in range(32)], 0, 1), ([1.0], 5, 2), (None, 0, 1), ([1.0, 2.0], 0, 900)], "x array<double>, a bigint, b bigint")
    assert [r.s for r in df.select(S.slice_samples(F.col("x"), F.col("a"), F.col("b")).alias("s")).collect()] == [[float(i) for i in range(16)], [], None, [1.0, 2.0]]
    here = str(tmp_path)
    assert [S.data_root(spark, "/n", here), S.data_root(spark, None, "/no/such", here, "/z"), S.data_root(spark, "", "/no/such", "/none")] == ["/n", here, "/none"]


def test_rosters(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"city": "C",\n "members": [{"name": "A", "aliases": ["x"]}, {"name": "B"}]}')
    (r,) = S.read_roster(spark, str(tmp_path / "r.json")).collect()
    assert (r.city, r.body, [(m.name, m.aliases) for m in r.members]) == ("C", "", [("A", ["x"]), ("B", [])])
    assert S.read_roster(spark, str(tmp_path / "none.json")).count() == 0


def test_meeting_documents_come_back_whole(spark, tmp_path):
    from podium.plans import base, render

    rows = render.meeting_document(spark, SF).orderBy("meeting_id", "part", "place").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r.meeting_id, []).append(r.fragment)
    for i, t in enumerate(texts.values()):
        (tmp_path / f"{i}.json").write_text("\n".join(t))
    docs = S.read_meetings(spark, str(tmp_path)).collect()
    assert {d.meeting_id for d in docs} == set(texts) and len(docs) == len(texts) > 3
    ids = base.meetings(spark, SF).select("meeting_id")
    seg = base.segments(spark, SF, "words").join(ids, "meeting_id").orderBy("meeting_id", "idx").collect()
    got = [(d.meeting_id, s.segment_id, round(s.start_time * 1000), s.speaker_label, s.text, len(s.words), s.speaker_name) for d in sorted(docs, key=lambda d: d.meeting_id) for s in d.segments]
    assert got == [(s.meeting_id, s.segment_id, s.start_ms, s.label, s.text or "", len(s.words or []), s.speaker_name) for s in seg]
    named = {(d.meeting_id, k, v.speaker_name, v.confidence, v.id_method, v.needs_review) for d in docs for k, v in d.speakers.items()}
    assert named == {tuple(x) for x in render.meeting_speakers(spark, SF).join(ids, "meeting_id", "left_semi").collect()}
    sections = {(d.meeting_id, i, s.section_type, s.title, s.content) for d in docs if d.summary for i, s in enumerate(d.summary.sections)}
    assert {x[2:] for x in sections} == {(x.section_type, x.title, x.content) for x in render.meeting_summaries(spark, SF).join(ids, "meeting_id", "left_semi").collect()}
    votes = [x.title for x in render.meeting_summaries(spark, SF).where("section_type = 'vote' and title <> ''").join(ids, "meeting_id", "left_semi").collect()]
    assert sorted(t for d in docs if d.summary for t in d.summary.key_decisions) == sorted(votes)


def test_exports(spark, tmp_path):
    from podium.plans.render import write_exports

    write_exports(spark, SF, str(tmp_path))
    assert spark.read.text(f"{tmp_path}/markdown").where("value like '**[%'").count() > 100
    assert spark.read.text(f"{tmp_path}/srt").where("value like '% --> %'").count() > 100


def test_stream_of_segments_equals_the_batch(spark, tmp_path):
    t = spark.read.parquet(f"{SF}/segments.parquet")
    t.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = speaker_totals(stream, "4000 days").writeStream.outputMode("update").foreachBatch(lambda df, i: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("meeting_id", "label").agg(F.max("segments").alias("segments"))
    want = speaker_totals(t)
    assert got.agg(F.sum("segments")).first()[0] == want.agg(F.sum("segments")).first()[0]
