"""Problem 10: template residue, filler, error pages and script notices in place of content.

Method: a text is cut into messages (lines and sentences); numbers, addresses, dates and times in
them are masked, and exact hashes of the masked messages of all documents are grouped across
sources. A message that recurs widely (in WIDE or more sources) counts if a rule suspects it, of
whatever length, or if it alone makes up documents again and again: at least ALONE of them and
OFTEN of all, in SPREAD of all sources. Mere recurrence is no ground: ordinary sentences recur too.
Exact for each document, without recurrence: phrase rules, and a placeholder or a program's empty
value where a value belongs. A document is a case by such a value, or if phrases, counting messages
and page furniture (menus, request numbers) make up COVER of its letters. Quoted strings and
teaching notation are taken out first, so texts that discuss such strings are no case.

Defined cases: null, empty and blank texts are no case; a text that repeats is judged each time;
null ids are left out; extra columns are ignored; an empty table gives no rows. Texts are read whole.
Masked messages are shuffled as 64-bit hashes with their source.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .needles import Needles, fold
from .textform import look

WIDE, COVER, REPEATS = 3, 0.7, 6  # sources of a widely recurring message; share of the letters that messages must cover; words of a repetition
ALONE, OFTEN, SPREAD = 20, 0.001, 0.25  # documents made of one message that no rule knows: how many, what share of all, in what share of all sources

# Phrase rules, fixed values. KO_THING: what a form asks for; the rest are the turns such messages take.
_FIELD = r"(?:이름|성명|고객명|회원명|담당자|작성자|날짜|일자|시간|주소|금액|가격|제목|부제목|링크|내용|본문|상품명|회사명|연락처|전화번호|이메일|번호|name|title|date|time|company|address|email|phone|order|link|url|price|amount|user|subject|content|body|[a-z]+(?:_[a-z]+)+|[A-Z]+(?:_[A-Z]+)+|[a-z]+(?:\.[a-z_]+)+|[a-z]+[A-Z][A-Za-z]*)"
_NAME = r"[\w.가-힣]+"
_PLACEHOLDER = re.compile(
    rf"""\{{\{{\s*{_NAME}\s*\}}\}}            # {{{{ x }}}}
    |\{{%\s*{_NAME}\s*%\}}|<%=?\s*{_NAME}\s*%>  # template tags
    |[$\#@]\{{\s*{_NAME}\s*\}}                 # ${{x}}, #{{x}}
    |\{{{_NAME}:[-=?][^{{}}]{{0,20}}\}}          # {{x:-default}}
    |\{{(?:\d{{1,2}}|{_FIELD})\}}               # {{0}}, {{title}}
    |\[\[\s*{_NAME}\s*\]\]|\[{_FIELD}\]        # [[x]], [title]
    |[\[<(〔【{{]\s*{_NAME}\s*(?:을|를)?\s*(?:입력|기재|기입|선택|작성|적어\s?주세요|입력해\s?주세요|넣어\s?주세요)\s*[\]>)〕】}}]
    |\((?:없음|미입력|미정)\s*:\s*[^()]{{1,15}}\)
    |[«‹]{{1,2}}\s*{_FIELD}\s*[»›]{{1,2}}
    |(?<![\w%])%{_FIELD}%|(?<![\w%])%[sd](?![\w%])
    |\${_FIELD}\$|&{_FIELD};|__{_FIELD}__|@@{_FIELD}@@|\#N/A
    |\[object\ Object\]""",
    re.X,
)
#: A program's empty value where a value belongs: after a label, alone, or with a unit, title or ending behind it.
_EMPTY = re.compile(
    r"""(?<![\w'"./])(?:undefined|null|NULL|None|NaN|nil|N/A)(?![A-Za-z0-9_'"/])
    (?:(?=\s*(?:원|점|님|개|명|건|씨|호)(?![가-힣]))|(?=\s*(?:원이며|점입니다|이고|이며|입니다|에서|로\s))|(?=\s+(?:고객님|회원님|학습자의|기준으로|님))|(?=\s*(?:[/|,;]|\n|$)))""",
    re.X,
)
_AFTER_LABEL = re.compile(r"[:=]\s*(?:undefined|null|NULL|None|NaN|nil|N/A|\[object Object\])\s*(?=[/|,;\n]|$)")
_WHERE, _PUT = r"(?:여기에?|이\s?(?:자리|칸|곳|영역|부분|란)에?|이곳에?|아래에)", r"(?:입력|작성|기재|추가)(?:하세요|해\s?주세요|해\s?주십시오|하십시오)|넣으세요|넣어\s?주(?:세요|십시오)|적어\s?주(?:세요|십시오)|적으(?:세요|시오|십시오)|써\s?(?:넣으)?(?:세요|시오|십시오)|써\s?주세요|쓰(?:세요|시오)|넣으(?:시오|십시오)"
_FILLER = re.compile(
    rf"""{_WHERE}\s[가-힣 ]{{1,15}}(?:을|를)\s(?:{_PUT})|[가-힣 ]{{1,12}}(?:을|를)\s(?:입력해\s?주세요|입력하세요|넣으세요)
    |{_WHERE}\s[가-힣 ]{{1,12}}(?:이|가)\s(?:들어갑니다|표시됩니다|들어갈\s?자리)|[가-힣]{{1,8}}(?:이|가)\s들어갈\s자리(?:입니다)?
    |(?:[가-힣]{{1,4}}글\s)*(?:여기에는\s)?실제\s(?:내용|글|본문)이\s아닌\s[가-힣 ]{{1,12}}(?:이|가)\s(?:들어갑니다|표시됩니다|들어갈\s자리입니다)
    |(?:샘플|예시|임시|더미)\s(?:문장|텍스트|글|내용|문구)(?:입니다|이\s표시됩니다|가\s표시됩니다)
    |(?<![가-힣])(?:본문|요약|질문|답변|머리말|소개\s글|제목|부제목|설명|상세\s내용|문구|내용)\s(?:샘플|예시|준비\s중|\(임시\)|작성\s예정|자리\s표시)\s?\d{{0,4}}(?:입니다)?
    |(?<![가-힣])내용\s준비\s중입니다|(?<![가-힣])작성\s예정(?![가-힣])|(?<![가-힣])본문\s\d{{1,3}}(?!\d*[가-힣])|(?<!\w)TBD(?!\w)|(?<!\w)(?:TODO|FIXME):\s?\S+(?:\s(?:작성|추가|입력|수정))?
    |(?i:your\stext\shere|insert\s(?:body\s)?(?:copy|text|content|title|image)\shere|(?:dummy|placeholder|sample|example)\s(?:headline|paragraph|caption|text|title|copy|content)\s(?:goes\shere|to\sbe\sreplaced|coming\ssoon|for\slayout\sonly|here)|(?:content|text)\sgoes\shere)
    |(?<!\w)(?:[xX]{{3,}}[\s.,]*){{2,}}""",
    re.X,
)
_LATIN = re.compile(r"(?<![a-z])(?:lorem|ipsum|dolor|sit|amet|consectetur|adipiscing|elit|sed|do|eiusmod|tempor|incididunt|ut|labore|et|dolore|magna|aliqua|enim|ad|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|aliquip|ex|ea|commodo|consequat)(?![a-z])[\s.,]*", re.I)
_LOREM = re.compile(r"lorem|ipsum|dolor|amet|aliqua|elit|tempor|consectetur|eiusmod|veniam|adipiscing|incididunt|nostrud", re.I)
_SYSTEM = r"(?:서버|시스템|네트워크|로그인|데이터\s?처리|데이터베이스|접속|통신|서비스|일시적인)"
_THING = r"(?:페이지|게시물|게시글|주소|파일|문서|자료|글|화면|콘텐츠|경로|항목)"
_ERROR = re.compile(
    rf"""(?i:(?:unhandled|unexpected|fatal|uncaught)\s(?:error|token|exception)\sin\s[\w./]+(?:\sline\s\d+)?)
    |{_SYSTEM}\s?(?:의\s)?(?:문제|장애|오류|과부하|에러)(?:로|가|이|로\s인해)?\s?(?:인해\s|생겨\s|감지되어\s|발생하여\s)?(?:요청을\s처리하지\s못했습니다|화면을\s표시할\s수\s없습니다|연결을\s종료합니다|발생했습니다|발생하였습니다)
    |(?:찾으시는|찾으신|[가-힣]{{2}}하신|해당)\s{_THING}(?:\s?(?:을\(를\)|은\(는\)|이\(가\)|을|를|은|는|이|가|의|에|에는))\s?(?:위치가\s변경되었습니다|(?:더\s이상\s)?(?:열|찾을|표시할|볼|이용할|접근할|접근하실|이용하실)\s수\s없습니다|찾지\s못했습니다|열지\s못했습니다|더\s이상\s제공되지\s않습니다|존재하지\s않(?:거나\s삭제되었)?습니다|삭제되었습니다|올바른지\s확인해\s주(?:시기\s바랍니다|세요))
    |서버에\s연결할\s수\s없습니다|데이터베이스\s연결에\s실패(?:하였|했)습니다|{_THING}(?:이|가)\s삭제되었거나\s비공개\s상태입니다|{_THING}(?:을|를)\s찾을\s수\s없습니다
    |접근\s권한이\s없습니다|잘못된\s(?:접근|요청)입니다|서비스\s점검\s중입니다|접속이\s지연되고\s있습니다|(?:세션|로그인\s시간)이\s만료되었습니다
    |(?:오류|에러)\s?(?:코드|번호)\s?:?\s?\d{{3}}|(?<!\w)HTTP\s?\d{{3}}(?!\d)|(?<!\w)\d{{3}}\s(?i:error)(?!\w)|(?<!\w)(?i:error)\s\d{{3}}(?!\d)|(?<!\S)[45]\d\d(?=\s*(?:$|\n|[-/|]\s)|\s(?=[가-힣]{{2}}하신\s|찾으시는\s|[A-Z]))
    |(?i:internal\sserver\serror|bad\sgateway|(?:page\s)?not\sfound(?!\smessage)|service\s(?:temporarily\s)?unavailable|access\sdenied|connection\s(?:timed\sout|refused)|gateway\stime-?out|too\smany\srequests|bad\srequest|forbidden|traceback\s\(most\srecent\scall\slast\)|(?:fatal|uncaught)\serror(?::\s)?|call\sto\sundefined\s(?:function|method)|[\w.]*(?:nullpointer|\w+)exception|the\srequested\s(?:url|page|resource)\swas\snot\sfound(?:\son\sthis\sserver)?|this\spage\sisn[’']t\sworking|you\sdon[’']t\shave\spermission\sto\saccess\sthis\sresource)
    |(?i:(?:oops|whoops|sorry|error)[,!:]\s(?:the\sserver\sdid\snot\srespond|(?:that|this)\s(?:link|page)\shas\sexpired|we\scould\snot\sload\sthis\spage|your\ssession\shas\s(?:ended|expired)|something\swent\swrong))
    |(?i:(?:unhandled|unexpected|fatal|uncaught)\s(?:error|token|exception)\sin\s[\w./]+(?:\sline\s\d+)?|(?:exception|error)\sin\s[\w./]+\sline\s\d+)""",
    re.X,
)
_JS, _JSEN = r"(?:자바\s?스크립트|스크립트|(?i:java\s?script)|쿠키)", r"(?i:java\s?script|js|scripting|scripts?|cookies)"
_SCRIPT = re.compile(
    rf"""{_JS}(?:와|과)?\s?(?:{_JS})?(?:을|를|이|가)?\s?(?:사용을\s|실행을\s|기능이\s|기능을\s)?(?:켜\s주(?:세요|십시오)|켜야\s(?:보입니다|합니다|이용할\s수\s있습니다)|허용한\s뒤\s다시\s접속하(?:십시오|세요)|허용해\s주(?:십시오|세요)|허용해야\s이용할\s수\s있습니다|필요합니다|지원하지\s않습니다|지원하는\s브라우저에서만\s열립니다|비활성화되어\s있(?:어|습니다)(?:\s내용을\s표시할\s수\s없습니다)?|꺼져\s있(?:으면\s동작하지\s않습니다|습니다)|차단되어\s화면을\s불러오지\s못했습니다)
    |스크립트\s실행이\s차단되어\s화면을\s불러오지\s못했습니다
    |(?:보안\s확인\s중입니다|(?:정상\s접속|사람|자동\s접속이\s아닌|로봇이\s아닌)(?:인|인지|지)?\s?(?:지\s)?확인(?:하고\s있습니다|한\s뒤\s화면이\s열립니다|이\s끝나면\s이동합니다|\s중입니다))
    |(?i:(?:please\s|you\sneed\sto\s)?(?:enable|turn\son|switch\son|activate|allow)\s{_JSEN}(?:\sand\s{_JSEN})?(?:\sto\s(?:view|run|see|continue|use)(?:\sthis\s(?:page|app|content|site))?|\sand\stry\sagain|\sin\syour\s(?:settings|browser)(?:,\sthen\sreload)?)?)
    |(?i:(?:this|the)\s(?:site|page|app)\srequires\s{_JSEN}(?:\sand\s{_JSEN})?|{_JSEN}\s(?:is|are)\s(?:disabled|required|blocked)(?:\sin\syour\sbrowser)?|checking\syour\sbrowser(?:\sbefore\saccessing)?|checking\sif\s(?:the\ssite\sconnection\sis\ssecure|you\sare\s(?:a\s)?human)|verify(?:ing)?\s(?:that\s)?you\sare\s(?:a\s)?human)""",
    re.X,
)
#: Page furniture and the small print of messages: counts as covered, but makes no case by itself.
_CHROME = re.compile(
    r"""(?i:\b(?:home|login|logout|sitemap|go\sback|menu|search|about|contact|request\sid|ray\sid)\b)|검색|공지사항|회원가입|새로고침|전체\s?메뉴|이용약관|로그인|로그아웃|사이트맵|홈|고객센터(?:에\s문의해\s주세요)?|이전으로|이전\s페이지|메인으로\s돌아가기|개인정보처리방침
    |(?:요청|접수|문의)\s번호:?\s?\w+|(?i:request\sid|ray\sid):?\s?\w+|처리\s시각\s\d+시?|경로:?\s?/\S+|(?:다시\s로그인해|잠시\s후\s다시\s시도해|잠시만\s기다려|다른\s브라우저를\s사용해)\s주세요|다시\s시도해\s주(?:세요|십시오|시기\s바랍니다)
    |이\s사이트를\s이용하려면|원활한\s이용을\s위해|브라우저\s설정에서|브라우저가|(?:본|이|해당|저희)\s(?:페이지|사이트|화면|문서|서비스|기능|누리집)(?:은|는|이|을|를)?|(?i:\bat\s[\w.-]+:\d+)|요청하신|찾으시는|입력하신|고객님|이용에\s불편을\s드려\s죄송합니다|관리자에게\s문의(?:해\s주세요|하세요)|쿠키와\s스크립트가\s필요합니다""",
    re.X,
)
_QUOTED = re.compile(r"'[^'\n]{1,80}'|‘[^’\n]+’|\"[^\"\n]+\"|“[^”\n]+”|「[^」\n]+」")
_MASKS = [(re.compile(r"https?://\S+|www\.\S+|[\w.+-]+@[\w-]+\.\S+|/[\w./-]{2,}|[\w-]+(?:\.[\w-]+)+(?::\d+)?"), "<u>"), (re.compile(r"\d{1,4}[년월일시분초](?:[^\S\n]?\d{1,2}[월일시분초])*|\d{1,4}[-./:]\d{1,2}(?:[-./:]\d{1,4})?"), "<d>"), (re.compile(r"(?=[0-9a-f]{6})(?=\w*\d)[0-9a-f]{6,}|\d+"), "<n>")]
#: Words that make a message suspect though no phrase rule knows it: it then counts if it recurs widely.
_SUSPECT = re.compile(r"오류|장애|접속|페이지|서버|브라우저|스크립트|쿠키|입력|점검 중|준비 중|예정|(?i:\b(?:error|javascript|browser|server|denied|unavailable|timeout|enable)\b)")
_CUT = re.compile(r"[\n\r|]+|\s[/>-]\s|(?<=[.!?])\s+")
_digit = re.compile(r"\d").search
_others = re.compile(r"\W+")
_letter = re.compile(r"\w").search
_status = re.compile(r"\s*[45]\d\d\s*").fullmatch  # a bare status number


def _letters(text: str) -> int:
    return len(_others.sub("", text))


def masked(*messages: str) -> list[str]:
    """Messages in lower case, with numbers, addresses, dates and times masked and blanks made one; no mask reaches over a line end."""
    (address, u), (date, d), (number, n) = _MASKS
    text = "\n".join([address.sub(u, m) if "@" in m or "/" in m or "." in m[:-1] else m for m in messages])  # else there is no address
    if _digit(text):
        text = number.sub(n, date.sub(d, text))
    return [" ".join(m.split()) for m in text.lower().split("\n")]


def _unquoted(text: str) -> str:
    """Without quoted strings, unless a quotation is all there is."""
    if not any(q in text for q in "'‘\"“「"):
        return text
    out = _QUOTED.sub(" ", text)
    return out if _letters(out) > 2 else text


#: A status number that stands free, as every match of the rules for bare numbers has one: quotes become blanks, messages end at these signs.
_CODE = re.compile(r"""[45](?<![^\s|'’"”」][45])\d\d(?=$|[\s|/'‘"“「-])""")  # the number first: most texts have none
#: Derived from the rules: a text without these needles matches none of them; plain substring search is far cheaper.
_blanks, _voids, _lorem, _words = Needles(_PLACEHOLDER), Needles(_EMPTY, _AFTER_LABEL), Needles(_LOREM), Needles(_LATIN)
_suspects, _furniture = Needles(_SUSPECT), Needles(_CHROME)
_word = re.compile(_LATIN.pattern.removesuffix(r"[\s.,]*")).search  # of a folded text
_phrases = [(Needles(rule, bare=_CODE), rule) for rule in (_SCRIPT, _FILLER, _ERROR)]


def _latin(folded: str) -> bool:
    return _lorem(folded) or _words(folded) and _word(folded) is not None


def explained(folded: str) -> bool:
    """Whether some message rule may match in a text: False is certain."""
    return any(may(folded) for may, _ in _phrases) or _latin(folded) or _CODE.search(folded) is not None


def filled_in(text: str) -> bool:
    """Whether a placeholder or an empty value stands where a value belongs."""
    low = fold(text)
    if _blanks(low) and _PLACEHOLDER.search(text):
        return True
    return _voids(low) and bool(_EMPTY.search(text) or _AFTER_LABEL.search(text))


@lru_cache(1 << 16)
def _message(message: str) -> tuple[bool, bool, int, int]:
    """(a rule matches, page furniture matches, letters neither explains, letters) of one line or sentence."""
    total, rest, hit, low = _letters(message), message, False, fold(message)
    for may, pattern in _phrases:  # what a rule takes out is a blank then and can't bring about another rule's needle
        if may(low):
            rest, n = pattern.subn(" ", rest)
            hit |= n > 0
    if not _latin(low):
        pass
    elif len(_LOREM.findall(rest)) >= 2 or not _letter(_LATIN.sub("", rest)) and (len(rest.split()) > 1 or _LOREM.search(rest)):
        bare = _LATIN.sub(" ", rest)
        hit, rest = hit or bare != rest, bare
    if _status(message):
        return True, False, 0, total
    bare, n = _CHROME.subn(" ", rest) if _furniture(low) else (rest, 0)
    return hit, n > 0, _letters(bare), total


def repetitive(text: str) -> bool:
    """Nothing but the same few words over and over."""
    words = text.split(None, 60)
    return len(words) >= REPEATS and len(set(words[:60])) <= 4 and len(set(text.split())) <= 4


def weigh(text: str | None) -> tuple[bool, list[tuple[str, int, int, bool]]]:
    """(is a case by the rules, (message, letters, letters that nothing explains, suspect) of every message)."""
    if not text or not text.strip():
        return False, []
    text = look(text)
    low = fold(text)
    case, seen = repetitive(text), _unquoted(text)
    case = case or (_blanks(low) or _voids(low)) and filled_in(seen)
    messages = [m.strip() for m in _CUT.split(seen) if m.strip()]
    suspect = _suspects(low)
    ruled, furnished = explained(low), _furniture(low)
    hit, out = False, []
    for m in messages:
        if ruled:
            rule, _, rest, n = _message(m)
            hit |= rule
        else:  # at most page furniture in it
            n = rest = _letters(m)
            if furnished and _furniture(fold(m)):
                rest = _letters(_CHROME.sub(" ", m))
        out.append((m, n, rest, suspect and _SUSPECT.search(m) is not None))
    return case or hit and _most(sum(rest for _, _, rest, _ in out), sum(n for _, n, _, _ in out)), out


def _most(left: int, total: int) -> bool:
    """Whether all but the letters ``left`` are COVER of ``total``."""
    return total > 0 and 1 - left / total >= COVER


def judge(text: str | None) -> tuple[bool, list[str]]:
    """(is a case by the rules, suspect messages of an open case: to be settled by recurrence)."""
    case, messages = weigh(text)
    return case, [] if case else [m for m, _, _, suspect in messages if suspect]


@lru_cache(1 << 12)
def _source(name: str | None) -> str:
    """Spellings of one source are one; all documents without a source count as one unknown source."""
    return " ".join(look(name or "").lower().split())


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_KIND = pa.struct([("m", pa.int64()), ("rest", pa.int32()), ("suspect", pa.bool_()), ("alone", pa.bool_())])


def _judged(batches):
    for batch in batches:
        cases, docs, lefts, totals, ends, flat = [], [], [], [], [0], ([], [], [], [])
        for text in batch.column(2).to_pylist():
            case, messages = weigh(text)
            total, own = sum(n for _, n, _, _ in messages), {}
            for m, (_, n, rest, suspect) in zip(masked(*(m for m, _, _, _ in messages)) if messages else (), messages):
                one = own.setdefault(_number(m), [0, 0, False])
                one[0], one[1], one[2] = one[0] + n, one[1] + rest, one[2] or suspect
            for h, (n, rest, suspect) in own.items():
                for column, x in zip(flat, (h, rest, suspect, _most(total - n, total))):
                    column.append(x)
            cases.append(bool(case))
            docs.append(_number(text))
            lefts.append(sum(rest for _, _, rest, _ in messages))
            totals.append(total)
            ends.append(len(flat[0]))
        own = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(flat, _KIND)], fields=list(_KIND))
        sources = [_source(s) for s in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(sources, pa.string()), pa.array(cases, pa.bool_()), pa.array(docs, pa.int64()), pa.array(lefts, pa.int64()), pa.array(totals, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), own)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "source", "is_case", "doc", "left_over", "total", "messages"])


def residue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id) of documents whose text is residue."""
    kind, scratch = df.schema[id_col].dataType.simpleString(), Scratch(df.sparkSession, "residue")
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    judged = scratch.keep(rows.mapInArrow(_judged, f"id {kind}, source string, is_case boolean, doc long, left_over long, total long, messages array<struct<m: long, rest: int, suspect: boolean, alone: boolean>>"), "judged")
    whole = judged.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("sources")).first()
    often = max(ALONE, OFTEN * whole["n"])
    messages = judged.select("source", F.inline("messages")).groupBy("m", "source").agg(F.max("suspect").alias("suspect"), F.sum(F.col("alone").cast("long")).alias("alone"))
    wide = messages.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.max("suspect").alias("suspect"), F.sum("alone").alias("alone")).where(F.col("n") >= WIDE)
    counting = scratch.keep(wide.where(F.col("suspect") | (F.col("alone") >= often) & (F.col("n") >= SPREAD * whole["sources"])).select("m"), "counting")
    # A text given twice under one id is one text here, so that its letters are not counted twice.
    known = judged.where("not is_case").select("id", "doc", "left_over", "total", F.inline("messages")).join(counting, "m").dropDuplicates(["id", "doc", "m"])
    settled = known.groupBy("id", "doc").agg(F.sum("rest").alias("rest"), F.max("left_over").alias("left_over"), F.max("total").alias("total")).where(F.expr(f"total > 0 and 1 - (left_over - rest) / total >= {COVER}D")).select("id")
    return judged.where("is_case").select("id").unionByName(settled).distinct()


def without_residue(df: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The clean rest, by an anti-join on the ids."""
    return df.join(found.select(F.col("id").alias(id_col)), id_col, "left_anti")
