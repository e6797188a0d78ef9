"""Problem 10: sentences of documents in any language and script, as offsets.

Method: a text is cut into blocks (blank lines, headings, list items), and each block by the kind of
script around a place. Spaced scripts: every run of terminators opens a small lattice of readings
(end, abbreviation, initial, ordinal, decimal, ellipsis, end inside a quotation or bracket), of which
the first that the neighbouring words support is taken. Spaceless scripts: words around a gap are
found by the cheapest path through a lattice of dictionary words, and the gap is classified by final
particles before it and opening or continuing words after it.

Offsets are code points, end exclusive, without white space at the ends, and all text but white
space is covered. Defined cases: null and blank texts have no sentences; texts of any length are
read whole, in time linear in them; an unclosed quotation or bracket does not count as one; repeated
rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from podium.sources.tables import table

#: Abbreviations after which a sentence goes on, in lower case without the last full stop (fixed values).
NEVER_LAST = frozenset("""
mr mrs ms dr prof rev hon gov sen rep gen col capt lt sgt mt messrs fig figs sec secs no nos vol vols ch pp pg art arts par app approx incl vs cf viz i.e e.g a.k.a al ca resp ed eds
ee sr sra srta srs dra d dña dn ing lic arq avda av núm nums pág págs cap tel apdo ud uds prov
m mm mme mlle env bd boul chap p n st ste
hr fr nr abs bzw z.b d.h u.a s rd mio mrd str tel usw.z evtl ggf vgl inkl zzgl bspw dipl
т.е т.ч т.к т.н ул стр ст пр пер г-н г-жа им тыс млн млрд рис гл пос д кв корп проф акад см ср
""".split())
#: Abbreviations that may stand last: a capital after them is an end, but for days, months and time zones.
MAYBE_LAST = frozenset("a.m p.m a.m p.m etc u.s.w usw и.т.д и.т.п др пр руб коп гг ft in oz lb sq".split())
#: Abbreviations, also of names of firms and streets, after which only an opening word is a new sentence.
SELDOM_LAST = frozenset("inc ltd co corp llc plc jr sr ave blvd rd st dept u.s u.k e.u u.n d.c h.t s.a uu kg gmbh".split())
#: Abbreviations that are words as well: in lower case before a capital they end a sentence (fixed values).
WORDS_TOO = frozenset("no nos art fig sec par app gen col ed cap tel ing".split())
#: Words that open sentences (fixed values); used where a capital alone does not tell.
OPENERS = frozenset("""
the a an this that these those there it he she we they you i in on at as if when while after before since because although however later meanwhile then what who why how where which is are was were
do does did can could should would will may might must no not one two some many all each every both another our their his her its my your for from to with by under over of and but or so yet staff
mr ms mrs dr prof today tomorrow yesterday tonight
""".split())
DATES = frozenset("""
monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december
januar februar märz mai juni juli oktober dezember est edt cst cdt mst mdt pst pdt gmt utc eastern central pacific mountain
""".split())
SPEECH = frozenset("said says asked asks told tells replied wrote writes added answered shouted called noted".split())

#: Thai words for the lattice (fixed values): openers, continuing words, units and common words.
THAI_OPENERS = frozenset("""
คุณ นาย นาง นางสาว ท่าน ผม ฉัน ดิฉัน เรา เขา เธอ มัน พวกเขา ที่ประชุม การประชุม คณะกรรมการ คณะ สมาชิก ชาวบ้าน ประชาชน ผู้ วิศวกร เจ้าหน้าที่ ประธาน นายก เทศบาล สภา รัฐบาล โครงการ งบประมาณ วาระ ญัตติ มติ เอกสาร
ดู โปรด กรุณา ขอ ขอบคุณ ใคร อะไร ทำไม เมื่อไร อย่างไร ที่ไหน วันนี้ พรุ่งนี้ เมื่อวาน ปีนี้ ปีหน้า ตอนนี้ ขณะนี้ ต่อมา จากนั้น ถ้า หาก เมื่อ หลังจาก ก่อน ในการ ใน สำหรับ ตาม ทั้งนี้ อย่างไรก็ตาม ดังนั้น นอกจากนี้ การ ความ นี่ นั่น ไม่ มี
""".split())
THAI_CONTINUING = frozenset("และ แต่ หรือ ซึ่ง ที่ เพราะ เพื่อ จึง โดย กับ ของ แล้วก็ รวมถึง ได้แก่ เช่น ว่า ให้ ไป มา ต่อ ถึง หน้า เสียง จุด นาฬิกา บาท ล้านบาท ล้าน พัน หมื่น แสน คน แห่ง ครั้ง ปี เดือน เดือนหน้า วัน วันที่ กิโลเมตร เมตร เซนติเมตร กิโลกรัม เปอร์เซ็นต์ ชั่วโมง นาที เลื่อน ประกอบด้วย ประมาณ น.".split())
THAI_FINAL = frozenset("แล้ว ครับ ค่ะ คะ นะ เลย ด้วย ไหม หรือไม่ ไว้ เถอะ หรอก ล่ะ เอง นี้ นั้น ออกไป เมื่อไร อย่างไร ทำไม ใคร อะไร".split())
#: Lao words for the lattice (fixed values).
LAO_OPENERS = frozenset("ຂ້ອຍ ຂ້າພະເຈົ້າ ເຮົາ ພວກເຮົາ ທ່ານ ເຈົ້າ ລາວ ເຂົາ ພວກເຂົາ ມັນ ທ້າວ ນາງ ກອງປະຊຸມ ຄະນະກຳມະການ ສະພາ ສະມາຊິກ ປະຊາຊົນ ປະທານ ລັດຖະບານ ໂຄງການ ງົບປະມານ ໃຜ ຫຍັງ ເປັນຫຍັງ ເມື່ອໃດ ມື້ນີ້ ມື້ອື່ນ ມື້ວານ ປີນີ້ ປີໜ້າ ຕອນນີ້ ຕໍ່ມາ ຈາກນັ້ນ ຖ້າ ເມື່ອ ຫຼັງຈາກ ກ່ອນ ດັ່ງນັ້ນ ນອກຈາກນັ້ນ ຂອບໃຈ ກະລຸນາ ການ ຄວາມ ບໍ່ ມີ".split())
LAO_CONTINUING = frozenset("ແລະ ແຕ່ ຫຼື ເຊິ່ງ ທີ່ ເພາະ ເພື່ອ ຈຶ່ງ ໂດຍ ກັບ ຂອງ ວ່າ ໃຫ້ ໄປ ມາ ຕໍ່ ເຖິງ ເຊັ່ນ ລວມທັງ ກີບ ລ້ານ ພັນ ໝື່ນ ແສນ ຄົນ ຄັ້ງ ປີ ເດືອນ ວັນ ວັນທີ ກິໂລແມັດ ແມັດ ກິໂລກຣາມ ເປີເຊັນ ຊົ່ວໂມງ ນາທີ ໂມງ ປະມານ".split())
LAO_FINAL = frozenset("ແລ້ວ ເດີ ເດີ້ ບໍ ບໍ່ ນໍ ເນາະ ຫວາ ນີ້ ນັ້ນ ດ້ວຍ ເອງ ເລີຍ".split())
_THAI_WORDS = THAI_OPENERS | THAI_CONTINUING | THAI_FINAL
_LAO_WORDS = LAO_OPENERS | LAO_CONTINUING | LAO_FINAL
_LONGEST = max(map(len, _THAI_WORDS | _LAO_WORDS))
#: Words that go on with the sentence even behind a final particle.
_LINKS = frozenset("และ แต่ หรือ ซึ่ง ที่ ແລະ ແຕ່ ຫຼື ເຊິ່ງ ທີ່".split())
#: Letters of a run from which on it may be a sentence where no word in it is known.
LEAST_SENTENCE = 10
#: After a closed quotation in Chinese or Japanese, what goes on with the sentence around it.
CJK_ON = ("と", "という", "って", "など", "の", "を", "は", "が", "に", "で", "へ", "も", "や", "随后", "随後", "然后", "然後", "接着", "接著", "并", "並", "便", "就", "后", "後", "的", "之", "而", "这", "這", "一", "，", "、", "；", ",", ";", "：", ":")
CJK_FINAL = tuple("了 吗 呢 吧 啊 です ます ました でした ません だ た か ね よ い る う く す ん".split())

_OPEN = {"(": ")", "（": "）", "[": "]", "【": "】", "「": "」", "『": "』", "《": "》", "〈": "〉", "«": "»", "„": "“”", "“": "”", "‚": "‘’", "‹": "›"}
_CLOSE = "”»」』）)]】》〉“›’\"'*"
_TERMINATOR = re.compile(r"[.!?。！？｡।॥؟۔…‥։።។။]+")
_PAIRS = re.compile("[" + re.escape("".join(_OPEN) + ")）]】」』》〉»”“›") + "]")
_BLANK = re.compile(r"\r?\n[^\S\n]*(?=\n|\r\n)|\n\s*\n|[ \x0c]|\r(?!\n)\s*\r(?!\n)")
#: At the beginning of a line.
_ITEM = re.compile(r"[^\S\n]*(?:\(?\d{1,3}[.)]|[-*•‣◦+]|[a-zA-Z][)])[^\S\n]+(?=\S)")
_HEADING = re.compile(r"[^\S\n]*#{1,6}[^\S\n]+[^\r\n]*")
_LABEL = re.compile(r"(?:>>\s*|[-–—]\s+)?(?:[\[(<]?\d{1,3}:\d\d(?::\d\d)?(?:[.,]\d+)?[\])>]?(?:\s*-->\s*(?:\d+:\d\d(?::\d\d)?(?:[.,]\d+)?)?)?\s*)?(?:>>\s*)?(?:(?:[^\s:：.!?]+|\w{1,4}\.)(?:[^\S\n]+(?:[^\s:：.!?]+|\w{1,4}\.)){0,4}[:：](?=\s)\s*|\[[^\]\n]{1,40}\]\s+)?")
_THAI_GAP = re.compile(r"(?<=\S)\s+(?=[฀-໿])")
_CJK_GAP = re.compile(r"(?<=[぀-ヿ㐀-鿿])[^\S\n\r]+(?=[぀-ヿ㐀-鿿])")
_LINE = re.compile(r"[\n\r]")
_QUOTE = re.compile("['’]")
_LETTERS = re.compile(r"(?:\w\.)+\w")
_RUN = re.compile("[\u0e00-\u0e7f]+|[\u0e80-\u0eff]+")
_SPACE = re.compile(r"\s")
_ADDRESS = re.compile(r"[@/.\\_]")
_WORD = re.compile(r"[^\W\d_][\w'’-]*")


def thai(c: str) -> bool:
    return "฀" <= c <= "໿"


def lao(c: str) -> bool:
    return "\u0e80" <= c <= "\u0eff"


def cjk(c: str) -> bool:
    return "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "豈" <= c <= "﫿"


def _lattice(run: str, known: frozenset[str]) -> tuple[str, ...]:
    """The cheapest path through the lattice of dictionary words; unknown letters cost most."""
    n = len(run)
    cost, back = [0.0] + [1e9] * n, [0] * (n + 1)
    for i in range(n):
        if cost[i] >= 1e9:
            continue
        for j in range(i + 1, min(n, i + _LONGEST) + 1):
            word = run[i:j] in known
            if word or j == i + 1:
                c = cost[i] + (1.0 if word else 1.5)
                if c < cost[j]:
                    cost[j], back[j] = c, i
    out, j = [], n
    while j:
        out.append(run[back[j] : j])
        j = back[j]
    return tuple(reversed(out))


_short_lattice = lru_cache(maxsize=100_000)(_lattice)


def spaceless_words(run: str) -> tuple[str, ...]:
    """The words of a run of Thai or Lao letters; runs of usual length are remembered."""
    known = _LAO_WORDS if lao(run[0]) else _THAI_WORDS
    return (_short_lattice if len(run) <= 200 else _lattice)(run, known)


def _thai_end(text: str, gap: re.Match) -> bool:
    """Whether a gap before a Thai or Lao letter ends a sentence: by the final particle before it and the word after it."""
    after = spaceless_words(_RUN.match(text, gap.end()).group())
    first = after[0]
    openers, continuing, final = (LAO_OPENERS, LAO_CONTINUING, LAO_FINAL) if lao(text[gap.end()]) else (THAI_OPENERS, THAI_CONTINUING, THAI_FINAL)
    last = text[gap.start() - 1]
    if thai(last):
        lo = gap.start()
        while lo and thai(text[lo - 1]):
            lo -= 1
        before = spaceless_words(text[lo : gap.start()])
        if before[-1] in _LINKS and before[-1] not in ("ที่", "ທີ່"):
            return False
        if first in continuing:
            return before[-1] in final and first not in _LINKS
        # Short runs of unknown words are members of a list.
        listed = [len(w) for w in (before, after)]
        unknown = [all(len(x) == 1 for x in w) for w in (before, after)]
        return not any(u and n < LEAST_SENTENCE for u, n in zip(unknown, listed, strict=True))
    if last.isdigit():
        return first in openers and len(first) > 2 and first not in ("ในการ",)
    return False


def _pairs(block: str) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Matched quotations and brackets, outermost only, and the place of each one's opening by its end."""
    stack: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []
    for m in _PAIRS.finditer(block):
        c, at = m.group(), m.start()
        if stack and c in stack[-1][0]:
            found.append((stack.pop()[1], at))
            continue
        deeper = next((k for k in range(len(stack) - 1, -1, -1) if c in stack[k][0]), None)
        if deeper is not None and c not in "“":
            found.append((stack[deeper][1], at))
            del stack[deeper:]
        elif c in _OPEN:
            stack.append((_OPEN[c], at))
    # Unclosed ones left on the stack do not count.
    found.sort()
    outer: list[tuple[int, int]] = []
    for a, b in found:
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
    return outer, {b: a for a, b in outer}


def _abbreviation(block: str, stop: int) -> str:
    """The word with inner full stops that ends at `stop`, in lower case; spaced initials like 'z. B' joined."""
    lo = stop
    while lo and (block[lo - 1].isalpha() or block[lo - 1] in ".'’-" or "ऀ" <= block[lo - 1] <= "ॿ"):
        lo -= 1
    word = _QUOTE.split(block[lo:stop].lstrip(".'’-").lower())[-1]
    if len(word) <= 2 and lo >= 3 and block[lo - 1].isspace() and block[lo - 2] == ".":
        k = lo - 2
        j = k
        while j and block[j - 1].isalpha():
            j -= 1
        if 0 < k - j <= 2:
            earlier = block[j:k].lower()
            if j >= 3 and block[j - 1].isspace() and block[j - 2] == "." and block[j - 3].isalpha() and (j < 4 or not block[j - 4].isalpha()):
                earlier = f"{block[j - 3].lower()}.{earlier}"
            joined = f"{earlier}.{word}"
            if joined in MAYBE_LAST or joined in SELDOM_LAST or joined in NEVER_LAST or len(earlier.split(".")[-1]) == len(word) == 1:
                return joined
    return word


def _goes_on(block: str, start: int, opened: int, after: int) -> bool:
    """After a closed quotation that ends in a terminator: whether the sentence around it goes on."""
    at = after
    while at < len(block) and block[at].isspace():
        at += 1
    if at >= len(block):
        return False
    c = block[at]
    leads = not any(x.isalnum() for x in block[start:opened])  # the sentence begins with the quotation
    if c in ",;:—–-،؛，、；：" or c in ".!?":
        return True
    if cjk(c) or at == after and not c.isspace() and cjk(block[max(0, opened - 1)]):
        if c in _OPEN:
            return False
        return leads or block.startswith(CJK_ON, at)
    if c.islower():
        return True
    if c.isupper():
        if at == after:
            return True
        if not leads:
            return False
        following = [m.group() for m in islice(_WORD.finditer(block, at), 4)]
        said = next((k for k, w in enumerate(following) if w in SPEECH), None)
        return said is not None and 0 < said and all(w[0].isupper() for w in following[:said]) and following[0].lower() not in OPENERS - {"mr", "ms", "mrs", "dr", "prof"}
    if c.isalpha() or c in "िं":  # scripts without case
        return leads
    return c.isdigit() and leads


@lru_cache(maxsize=8)
def _places(block: str) -> tuple[list[int], list[int]]:
    """Where white space is, and the signs of addresses; for the block at hand."""
    return [m.start() for m in _SPACE.finditer(block)], [m.start() for m in _ADDRESS.finditer(block)]


def _in_address(block: str, at: int) -> bool:
    """Whether the unbroken token before `at` holds a sign of an address or another full stop."""
    spaces, signs = _places(block)
    i, k = bisect_left(spaces, at), bisect_left(signs, at)
    return k > 0 and signs[k - 1] > (spaces[i - 1] if i else -1)


def _word_before(block: str, at: int) -> str:
    """The word before the one that ends at `at`; '' if something else than white space lies between."""
    hi = at
    while hi and (block[hi - 1].isalnum() or block[hi - 1] == "_"):
        hi -= 1
    gap = hi
    while gap and block[gap - 1].isspace():
        gap -= 1
    lo = gap
    while lo and (block[lo - 1].isalnum() or block[lo - 1] in "_'’-"):
        lo -= 1
    while lo < gap and not block[lo].isalpha():
        lo += 1
    return block[lo:gap] if gap < hi else ""


def _lost_space(block: str, at: int, nxt: int) -> bool:
    """A full stop between a small letter and a word with a capital: an end whose space was lost, or an address or decimal."""
    if not (block[at - 1].islower() and block[nxt].isupper() and (block[nxt + 1 : nxt + 2].islower() or block[nxt + 1 : nxt + 2].isspace() or block[nxt + 1 : nxt + 2] in (".", "'", "’"))):
        return False
    word = _abbreviation(block, at)
    if word in MAYBE_LAST:
        return True
    return len(word) > 1 and word not in NEVER_LAST and not _in_address(block, at)


def _ends_at_stop(block: str, at: int, end: int, mark: str) -> bool:
    """Whether the terminators block[at:end] (with closing signs up to `end`) end a sentence."""
    n = len(block)
    nxt = end
    while nxt < n and block[nxt].isspace():
        nxt += 1
    if nxt >= n:
        return True
    c = block[nxt]
    before = block[at - 1] if at else " "
    if nxt == end:
        return mark == "." and end == at + 1 and _lost_space(block, at, end)
    if c in ",;:—–،؛" or c in "!?.)" or (c == "-" and not block[nxt + 1 : nxt + 2].isspace()):
        return c in "—–" and mark[0] not in "!?" and block[nxt + 1 : nxt + 2].isalpha()
    if c.islower():
        return False
    ellipsis = "…" in mark or mark.count(".") > 1
    if ellipsis:
        return c.isupper() or c in _OPEN or c in "¿¡#"
    if mark != ".":
        return True
    word = _abbreviation(block, at)
    following = _WORD.match(block, nxt)
    follows = following.group().lower() if following else ""
    if word:
        if word in MAYBE_LAST:
            return (c.isupper() or c in _OPEN or c in "¿¡" or not c.isalnum()) and follows not in DATES
        if word in SELDOM_LAST and word not in ("st", "sr", "rd"):
            return follows in OPENERS or c in _OPEN or not c.isalnum()
        if word in ("st", "sr", "rd"):
            # A street, if a name with a capital stands before; a saint or a title otherwise.
            name = _word_before(block, at)
            street = name[:1].isupper() and name.lower() not in OPENERS
            return street and follows in OPENERS
        if word in WORDS_TOO and c.isupper() and block[at - len(word)].islower():
            return True
        if word in NEVER_LAST or word.endswith("str") and len(word) > 4 and c.islower():
            return False
        if len(word) == 1:  # an initial, also in scripts without case; or the first of several
            return before.islower() and not (len(follows) == 1 and block[nxt + 1 : nxt + 2] == ".")
        if _LETTERS.fullmatch(word):
            return follows in OPENERS
        if "ऀ" <= word[0] <= "ॿ":
            return "." not in word and sum(x.isalpha() for x in word) > 2
    if before.isdigit() and follows in DATES:
        return False  # an ordinal before a month
    return True


def _block_ends(block: str, lead: int) -> list[int]:
    """Ends of the sentences inside a block; `lead` is where its first sentence begins after a label."""
    outer, opened_at = _pairs(block)
    ends: list[int] = []
    start, k = lead, 0
    gaps = [m for m in _THAI_GAP.finditer(block)] + [m for m in _CJK_GAP.finditer(block)]
    marks = sorted([(m.start(), m) for m in _TERMINATOR.finditer(block)] + [(m.start(), m) for m in gaps], key=lambda x: x[0])
    for at, m in marks:
        if at < lead:
            continue
        if m.re is _THAI_GAP or m.re is _CJK_GAP:
            if any(a < at < b for a, b in outer[max(0, k - 1) : k + 1]):
                continue
            last = block[at - 1]
            if m.re is _THAI_GAP and _thai_end(block, m) or m.re is _CJK_GAP and block.endswith(CJK_FINAL, 0, at) and not last.isspace():
                ends.append(at)
                start = m.end()
            continue
        while k < len(outer) and outer[k][1] < at:
            k += 1
        end = m.end()
        mark = m.group()
        inside = k < len(outer) and outer[k][0] < at < outer[k][1]
        if inside:
            # Only what closes the quotation right behind can end the sentence.
            a, b = outer[k]
            rest = block[end:b]
            if rest.strip(_CLOSE + "   "):
                continue
            end = b + 1
            while end < len(block) and block[end] in _CLOSE and end not in opened_at and not any(p == end for p, _ in outer[k + 1 : k + 2]):
                end += 1
            nxt = _TERMINATOR.match(block, end)
            if nxt:  # a terminator of the sentence around follows at once
                continue
            if block[a] in "(（[【《〈" and not a <= start:
                if _ends_at_stop(block, at, end, "!") and not any(x.isalnum() for x in block[start:a]):
                    ends.append(end)
                    start = end
                continue
            if _goes_on(block, start, a, end):
                continue
            if end < len(block) and not block[end].isspace() and not cjk(block[end]) and mark[0] not in "。！？" and block[end] not in _OPEN:
                continue
            ends.append(end)
            start = end
            continue
        while end < len(block) and block[end] in _CLOSE and not any(p == end for p, _ in outer[k : k + 2]):
            end += 1
        wide = mark[0] in "。！？｡"
        if wide or mark[0] in "।॥۔።។။":
            if not (mark[0] in "！？" and end < len(block) and block[end] in "，、；,") :
                ends.append(end)
                start = end
            continue
        if mark[0] in "…‥" and (end >= len(block) or cjk(block[end])):
            if end >= len(block):
                ends.append(end)
            continue
        if cjk(block[at - 1]) if at else False:
            if mark == "." and end < len(block) and not block[end].isspace():
                continue
        if _ends_at_stop(block, at, end, mark):
            ends.append(end)
            start = end
    return ends


def _blocks(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole): paragraphs, headings and list items; headings and items are whole."""
    cuts = [(0, 0)] + [m.span() for m in _BLANK.finditer(text)] + [(len(text), len(text))]
    for (_, lo), (hi, _) in zip(cuts[:-1], cuts[1:], strict=True):
        if not text[lo:hi].strip():
            continue
        marks: list[tuple[int, int, bool]] = []
        part = text[lo:hi]
        heads = "#" in part
        past = 0
        for at in (0, *[m.end() for m in _LINE.finditer(part)]):
            if heads and at >= past and (not at or part[at - 1] == "\n") and (m := _HEADING.match(part, at)):
                marks.append((m.start(), m.end(), True))
                past = m.end()
            if not (m := _ITEM.match(part, at)):
                continue
            date = _WORD.match(part, m.end())
            if not (date and date.group().lower() in DATES and m.start() and m.group().rstrip().endswith(".")):  # a wrapped ordinal is none
                marks.append((m.start(), -1, True))
        marks.sort()
        at = 0
        for i, (a, b, _) in enumerate(marks):
            if a < at:
                continue
            if part[at:a].strip():
                yield lo + at, lo + a, False
            stop = b if b >= 0 else marks[i + 1][0] if i + 1 < len(marks) else len(part)
            yield lo + a, lo + stop, True
            at = stop
        if part[at:].strip():
            yield lo + at, hi, False


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Offsets (start, end) of the sentences of a text."""
    out: list[tuple[int, int]] = []
    if not text:
        return out

    def add(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))

    for lo, hi, whole in _blocks(text):
        if whole:
            add(lo, hi)
            continue
        block = text[lo:hi].rstrip()
        skip = len(block) - len(block.lstrip())
        label = _LABEL.match(block, skip)
        lead = label.end() if label and label.end() < len(block) else skip
        if lead > skip and block[lead] in _OPEN and any(c.isalpha() and not (c.isupper() or c.islower()) for c in block[skip:lead]):
            lead = skip  # in a script without case, words and a colon before a quotation introduce it
        at = 0
        for end in _block_ends(block, lead):
            if any(not c.isspace() for c in block[at:end]):
                add(lo + at, lo + end)
            at = end
        add(lo + at, lo + len(block))
    return out


def split_sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start_pos, end_pos), one row a sentence: a map over the scan."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                found = [sentences(t) for t in part.column(1).to_pylist()]
                rows = pa.array([i for i, f in enumerate(found) for _ in f], pa.int32())
                starts = pa.array([a for f in found for a, _ in f], pa.int32())
                ends = pa.array([b for f in found for _, b in f], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), starts, ends], names=[key, "start_pos", "end_pos"])

    return df.select(key, text).mapInArrow(run, f"{key} {kind.simpleString()}, start_pos int, end_pos int")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sentences(table(spark, sf_dir, "documents"))
