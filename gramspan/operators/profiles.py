"""First-pass profiles of two units: ordered lists of steps over the span and the text around it; the first that fits holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.textfn import java_pattern


@dataclass(frozen=True)
class Step:
    """Fits where the span is one of ``spans`` (any, if none are given) and, if there are ``looks``, one (field, pattern) of them is found."""

    label: str
    span_status: str
    reason: str
    note: str
    spans: tuple[str, ...] = ()
    looks: tuple[tuple[str, str], ...] = ()

    def fits(self, span: Column) -> Column:
        ok = span.isin(*self.spans) if self.spans else F.lit(True)
        if self.looks:
            found = F.lit(False)
            for name, pattern in self.looks:
                place = {"span": span, "around": F.concat("before", span, "after")}.get(name, F.col(name) if name not in ("span", "around") else None)
                found = found | F.coalesce(place.rlike(java_pattern(pattern)), F.lit(False))
            ok = ok & found
        return ok


@dataclass(frozen=True)
class StepProfile:
    steps: tuple[Step, ...]
    default: tuple[str, str, str, str]

    def column(self) -> Column:
        """struct(label, span_status, reason, note); needs the context columns of a first pass."""
        span = F.coalesce(F.nullif(F.col("span_text"), F.lit("")), F.col("regex_match_text"), F.lit(""))
        make = lambda label, status, reason, note: F.struct(F.lit(label).alias("label"), F.lit(status).alias("span_status"), F.lit(reason).alias("reason"), F.lit(note).alias("note"))
        out = make(*self.default)
        for s in reversed(self.steps):
            out = F.when(s.fits(span), make(s.label, s.span_status, s.reason, s.note)).otherwise(out)
        return out


#: Spans of the connective ending that is productive.
PRODUCTIVE = ("는데", "은데", "인데", "한데", "건데", "텐데", "닌데", "큰데", "신데", "던데", "언데", "든데", "긴데", "땐데", "뭔데", "젠데", "딘데", "븐데")

_NOT = ("fp", "not_applicable")
#: Verdicts, reasons, notes, spans and patterns of the two units.
UNCLASSIFIED = ("unclear", "ok", "unclassified", "자동 규칙으로 분류하지 못함")
CONNECTIVE_DE = StepProfile(
    (
        Step(*_NOT, "lexicalized_discourse_marker_geureonde", "그런데/그런데도 계열 접속부사로 보임", ("런데",), (("window", "그런데"),)),
        Step(*_NOT, "lexicalized_discourse_marker_geunde", "근데 담화표지/접속부사로 보임", ("근데",)),
        Step(*_NOT, "place_noun_gunde", "군데 장소/수량 명사로 보임", ("군데",), (("raw_text", r"(몇|한|두|세|네|\d+)\s*군데"), ("next_char", "^[가를에도 ]$"))),
        Step("tp", "ok", "copula_contracted_gunde", "친군데 등 -인데 축약 가능성이 큼", ("군데",)),
        Step(*_NOT, "lexical_noun_or_loanword", "가운데/파운데이션 등 어미가 아닌 단어 내부로 보임", ("운데",), (("raw_text", "가 *운 *데|파 *운 *데 *이 *션"),)),
        Step(*_NOT, "loanword_pandemic", "팬데믹 단어 내부", ("팬데",), (("raw_text", "팬데믹"),)),
        Step(*_NOT, "loanword_or_title_oneday", "원데이/고유명 표현 내부 가능성이 큼", ("원데",), (("raw_text", "원데이"), ("around", " 원"))),
        Step(*_NOT, "lexicalized_ondegande", "온데간데 단어 내부", ("온데",), (("raw_text", "온데간데"),)),
        Step("unclear", "ok", "noisy_or_nonstandard_form", "학습자/구어 비표준 표기 또는 담화표지 오타 가능성 있어 확인 필요", ("천데", "끈데")),
        Step("tp", "ok", "productive_connective_ending", "ㄴ/은/는데 계열 연결어미 또는 이다/용언 결합으로 보임", PRODUCTIVE),
        Step("tp", "ok", "tentative_connective_ending", "형태상 ㄴ/은/는데 계열 후보로 보이나 최종 확인 필요", (), (("span", r"데\Z"),)),
    ),
    UNCLASSIFIED,
)
AUXILIARY_MALDA = StepProfile(
    (
        Step(*_NOT, "speech_verb_malhada", "인용/발화 동사 '말하다/말씀하다' 계열로 보임", (), (("after", r"^(했|했다|했고|했는|하며|해|하면|하기|하긴|하는|전했|씀|을\b)"), ("window", r"고\s*말(?:씀|하|했|해|전했|을\s+하)"))),
        Step(*_NOT, "lexical_noun_mal", "명사 '말' 또는 '말이야' 담화 표현으로 보임", (), (("after", r"^(이야|이\s|이[가-힣])"),)),
        Step("tp", "ok", "auxiliary_go_malda", "보조용언 '고 말다'의 완료/의지 표현으로 보임", (), (("compact_text", "고(?:야)?말(?:았|겠|거|다|고야)"), ("after", "^(았|겠|거|다)"))),
        Step("unclear", "ok", "tentative_go_malda", "형태상 고 말다 후보이나 말하다/명사 말 가능성 확인 필요", (), (("span", r"^(고 말|고 \.\.\. 말)\Z"), ("regex_match_text", "^고"))),
    ),
    UNCLASSIFIED,
)
#: Profiles by unit.
PROFILES = {"ps_ce002": CONNECTIVE_DE, "ps_df004": AUXILIARY_MALDA}
