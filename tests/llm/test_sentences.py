import random

import pytest

from podium.llm.sentences import sentences, split_sentences

TEXTS = [
    ["Mr. Ames met Dr. B. C. Dow at 5:00 p.m. on Monday.", "It rose 3.5 percent, vs. 2 before.", "See Fig. 3 and Sec. 4.2 of the file."],
    ["The session ended at 7:30 p.m.", "The clerk left."], ["He began at 5:00 a.m. Monday and stayed.", "Really?!", "Yes."],
    ["The parcel at 25 St. Osier Ave. drains toward Saddler St. and beyond.", "The U.S. agency paid."], ["“Is it safe?” asked J. R. Low before the vote.", "He said, “Go home.”", "“It floods,” Ann told Bo, “and nobody comes.”", "That failed (again!) on Tuesday."],
    ["The estimate was ... let us say optimistic.", "Write to clerk@packet.example or room 9.", "Who pays?"],
    ["Herr Rau sagte: „Wir warten.“", "„Wann?“, fragte sie.", "Am 4. März kamen ca. 3 Mio. Euro, d. h. genug.", "Laut § 3 Abs. 2 gilt das."],
    ["« Et si le pont cède ? » demande une riveraine.", "Le Dr Roy a répondu : « C’est trop tard. »", "L’art. 4, cf. p. 9, reste.", "Quelle soirée !", "M. Roy habite bd. Fuller."],
    ["¿Y si pasa?, preguntó una vecina del núm. 4.", "¡Qué pena!", "Vinieron de EE. UU. y de aquí.", "Salió a las 9:15 a. m. del lunes."],
    ["«Когда?» — спросил житель дома № 3.", "А. П. Торвано сослался на ст. 5 и стр. 3.", "Зал был полон... но тих.", "Это т. е. план."],
    ["डॉ. राव ने कहा, “हम नहीं रुकेंगे।”", "“कब?” एक निवासी ने पूछा।", "लंबाई 3.5 कि.मी. है।"], ["قال د. برزان: «لن ننتظر.»", "من يدفع؟", "انتهت الجلسة في الساعة 5:30 مساء."],
]
SPACELESS = [
    ["“这座桥安全吗？”柏棠问道。", "居民说：“我们不能再等了。”", "柏棠说：“先修。”随后离开了。", "费用为3.5亿元……但没有说明。", "太失望了！"],
    ["住民は「もう待てません。すぐ直して。」と述べた。", "えっ、本当ですか！？", "資料No.5の3.5ページを見て。", "「橋は安全か？」と尋ねた。"],
]


@pytest.mark.parametrize("parts", TEXTS + SPACELESS, ids=lambda p: p[0][:12])
def test_known_boundaries(parts):
    sep = "" if parts in SPACELESS else " "
    text = sep.join(parts)
    assert [text[a:b] for a, b in sentences(text)] == parts
    wrapped = ("" if not sep else "\n").join(parts)
    assert [wrapped[a:b] for a, b in sentences(wrapped)] == parts


def test_thai_gaps():
    parts = ["วาระที่ 29 เลื่อนไปวันที่ 2 เดือนหน้า", "งบประมาณประมาณ 0.8 ล้านบาท", "ใครจะรับผิดชอบเรื่องนี้", "ที่ประชุมลงมติเห็นชอบ 18 ต่อ 26 เสียง"]
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences(text)] == parts


def test_lists_and_other_spaceless_scripts():
    for parts in (
        ["ที่ประชุมซื้อ ปากกา ดินสอ ที่ร้าน"], ["ຂ້ອຍໄປຕະຫຼາດແລ້ວ", "ກອງປະຊຸມເລີ່ມແລ້ວ ແລະ ທຸກຄົນມາ"], ["今日は天気がいい", "明日は雨かも"], ["He was in Washington D.C.", "Tomorrow he leaves."],
        ["ខ្ញុំទៅផ្សារ ហើយត្រឡប់មកវិញ។", "គាត់មិនទៅទេ។"], ["ကျွန်တော် ဈေးသွားတယ်။", "သူ မလာဘူး။"],
    ):
        text = " ".join(parts)
        assert [text[a:b] for a, b in sentences(text)] == parts


def test_long_runs_take_linear_time():
    import time

    for unit in ("วาระที่", "a.Ba@", "Smith St. ", "ที่ 5 ", "“x.” "):
        took = []
        for n in (4_000, 32_000):
            text = unit * n
            began = time.perf_counter()
            assert sentences(text)[-1][1] == len(text.rstrip())
            took.append(time.perf_counter() - began)
        assert took[1] < 24 * took[0] + 1, (unit, took)


def test_blocks():
    text = "## Head. Line\nBody one. Body two.\r\n\r\n1. Item. Still item\n- Other\n\nSpeaker 4: Dr. A spoke. Then left.\n\n[01:02] Yes. No.\n \nlast"
    assert [text[a:b] for a, b in sentences(text)] == ["## Head. Line", "Body one.", "Body two.", "1. Item. Still item", "- Other", "Speaker 4: Dr. A spoke.", "Then left.", "[01:02] Yes.", "No.", "last"]


def test_labels_hold_no_sentence():
    for parts in (["J. R. Low: It is so.", "Yes."], ["Staff agreed.", "Then: no.", "End."], [">> DR. ROY: Hm. no?", "Yes."]):
        text = " ".join(parts)
        assert [text[a:b] for a, b in sentences(text)] == parts


def test_lost_spaces():
    text = "He left the podium.Questions came at 5:00 p.m.The clerk wrote to Ann@Mail.Example or a.B and Mr.Low, see x/y.Txt now."
    assert [text[a:b] for a, b in sentences(text)] == ["He left the podium.", "Questions came at 5:00 p.m.", "The clerk wrote to Ann@Mail.Example or a.B and Mr.Low, see x/y.Txt now."]


def test_wrapped_lines_are_no_items():
    text = "Am Montag, dem\n21. Oktober, kam er. «Когда?»\n— спросил он.\n- Eins\n- Zwei"
    assert [text[a:b] for a, b in sentences(text)] == ["Am Montag, dem\n21. Oktober, kam er.", "«Когда?»\n— спросил он.", "- Eins", "- Zwei"]


def test_everything_is_covered_once():
    r = random.Random(4)
    parts = list("abcA.!?。”“«»()（「」\n\r \t…:;-#*1०กข ์中。") + ["\n\n", "Mr. ", "\r\n\r\n", "- x", "1. "]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 60)))
        at = 0
        for a, b in sentences(text):
            assert at <= a < b <= len(text) and not text[at:a].strip() and not text[a].isspace() and not text[b - 1].isspace()
            at = b
        assert not text[at:].strip()


def test_frame(spark):
    long = "One two. " * 30000
    df = spark.createDataFrame([(1, "A b. C d.", 5), (2, None, 5), (3, " \n ", 5), (4, "", 5), (5, long, 5), (1, "A b. C d.", 6)], "doc_id bigint, text string, start_pos int")
    rows = split_sentences(df).collect()
    assert sorted((r.start_pos, r.end_pos) for r in rows if r.doc_id == 1) == [(0, 4), (0, 4), (5, 9), (5, 9)]
    assert sum(r.doc_id == 5 for r in rows) == 30000 and {r.doc_id for r in rows} == {1, 5}
    assert split_sentences(df.limit(0)).count() == 0
