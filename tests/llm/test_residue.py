"""The prefilter of the residue rules, and messages grouped over sources."""

import random
from re import _constants as op
from re import _parser

import pytest

from gramspan.llm import residue as R
from gramspan.llm.needles import Needles, fold

RULES = {"placeholder": (R._PLACEHOLDER, R._blanks), "empty": (R._EMPTY, R._voids), "label": (R._AFTER_LABEL, R._voids), "latin": (R._LATIN, R._latin), "lorem": (R._LOREM, R._latin)} | {n: (rule, may) for n, (may, rule) in zip(("script", "filler", "error"), R._phrases)}
NAMED = ["BAD GATEWAY", "403 FORBIDDEN", "LOREM IPSUM DOLOR SIT AMET", "Your Text Here", "INTERNAL SERVER ERROR", "해당 게시물은 삭제되었습니다", "해당 자료는 존재하지 않습니다", "해당 페이지는 존재하지 않습니다", "찾으신 문서는 열지 못했습니다", "더미 텍스트입니다.", "임시 문구입니다.", "여기에 제목을 적어주세요", "404\n홈 로그인 검색"]


def example(items, rng):
    """A string that the parsed rule may match; what takes up no text is left to chance."""
    out = ""
    for kind, arg in items:
        if kind is op.LITERAL:
            out += rng.choice([chr(arg), chr(arg).upper()[:1], chr(arg)])
        elif kind is op.IN:
            k, x = rng.choice(arg)
            out += {op.LITERAL: lambda x: chr(x), op.RANGE: lambda x: chr(rng.randint(*x)), op.CATEGORY: lambda x: {op.CATEGORY_SPACE: " ", op.CATEGORY_DIGIT: "4"}.get(x, "a"), op.NEGATE: lambda _: "-"}[k](x)
        elif kind is op.SUBPATTERN:
            out += example(arg[-1], rng)
        elif kind is op.BRANCH:
            out += example(rng.choice(arg[1]), rng)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            out += "".join(example(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
        elif kind in (op.NOT_LITERAL, op.ANY):
            out += "가"
    return out


@pytest.mark.parametrize("name", RULES)
def test_prefilter_passes_what_the_rule_matches(name):
    rule, may = RULES[name]
    rng, tree = random.Random(7), _parser.parse(rule.pattern, rule.flags)
    texts = [a + example(tree, rng) + b for _ in range(6000) for a, b in [rng.choice([("", ""), ("가 ", " 나"), ("값: ", ", 끝")])]]
    matched = [t for t in texts if rule.search(t)]
    assert len(matched) > 300 and [t for t in matched if not may(fold(t))] == []


def test_named_texts_are_cases():
    assert [t for t in NAMED if not R.judge(t)[0]] == []


def test_rule_without_needles_is_refused():
    with pytest.raises(ValueError):
        Needles(R.re.compile(r"abc|\d+"))


def test_any_message_is_grouped(spark):
    said = "The old gate keeper sends his regards"  # ordinary: recurs, but not that often
    long = "귀하께서 지금 보고 계신 화면은 저희 쪽 서버 사정 탓에 원래 모습 그대로 나오지 못하고 있으니 이 점 널리 헤아려 주시고 나중에 한가한 때에 다시 들러 주시면 고맙겠다는 말씀을 드립니다"
    rows = [(k, f"s{k % 4}", "Just a moment...") for k in range(24)] + [(100 + k, f"s{k}", said) for k in range(4)] + [(200 + k, f"s{k}", long) for k in range(3)]
    rows += [(300, "s1", "Just a moment... 그런데 이 글에는 다른 이야기가 아주 길게 이어진다고 한다"), (301, "s1", "Just a moment...\n홈 검색")]
    # Half of a text is such a message; given twice under one id it still is half.
    rows += [(302, "s1", "Just a moment...\n그것은 달랐다고 했다")] * 2 + [(303, "s1", "오늘은 비가 온다고 했다")]
    assert len(long) > 80
    got = {r.id for r in R.residue(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == {*range(24), 200, 201, 202, 301}


def test_furniture_of_any_length_and_share_of_wide_messages(spark):
    assert R.judge("요청하신 페이지를 찾을 수 없습니다 " + "홈 검색 공지사항 로그인 " * 60)[0]
    wide = "이 브라우저 버전은 지원 대상이 아니므로 새 판으로 바꾸어야 합니다"
    rows = [(k, f"s{k}", wide) for k in range(3)] + [(9, "s1", f"{wide}\n서버 가나")]
    got = {r.id for r in R.residue(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == {0, 1, 2, 9}


def test_sources_are_counted_exactly(spark):
    text = "브라우저 버전이 낮음"
    schema = "doc_id long, source string, text string"
    one = [(k, s, text) for k, s in enumerate(["Ａ", " a", "A", None, " "])]
    assert R.residue(spark.createDataFrame(one, schema)).count() == 0
    # Every message comes from exactly three sources.
    rows = [(3 * k + j, f"s{3 * k + j}", f"브라우저 이름 {chr(0xAC00 + k)} 낮음") for k in range(700) for j in range(3)]
    assert R.residue(spark.createDataFrame(rows, schema)).count() == len(rows)
