"""Term lists as data.  The default lexicon and one for tables without its vocabulary."""

from __future__ import annotations

from dataclasses import dataclass, field

# fixed values: kinds, bands, decisions
KINDS = ("project_state", "user_preference", "decision", "operation_rule", "fact", "relationship", "todo")
BANDS = ("low", "medium", "high", "critical")
DECISIONS = ("reject", "archive_only", "defer", "promote")

# fixed values: lines that are dropped if one of these matches at their start
NOISE_LINES = (
    r"(?i)^\[Thread starter - for context\]", r"(?i)^dream$", r"(?i)^__cron$", r"(?i)^cron$", r"(?i)^\[cron:",
    r"(?i)^Conversation info \(untrusted metadata\):", r"(?i)^Sender \(untrusted metadata\):", r"(?i)^```json$", r"^```$", r"^\{\s*$", r"^\}\s*$",
    *(rf'(?i)^"{name}":' for name in (
        "message_id", "sender_id", "conversation_label", "sender", "timestamp", "group_subject", "group_channel", "group_space",
        "thread_label", "topic_id", "is_group_chat", "label", "id", "name", "username", "tag",
    )),
    *(rf"(?i)^\[{day} .* GMT\+9\]" for day in ("Fri", "Thu", "Wed", "Tue", "Mon", "Sun", "Sat")),
)

# fixed values: pieces of a line that turn into a space
NOISE_PIECES = (
    r"(?i)\[Thread starter - for context\]", r"(?i)Conversation info \(untrusted metadata\):", r"(?i)Sender \(untrusted metadata\):",
    r"(?i)\[cron:[^\]]+\]", r"(?i)__cron", r"(?i)(?<![A-Za-z0-9_])dream(?![A-Za-z0-9_])",
)

# fixed values: acknowledgements that carry no signal
LOW_SIGNAL = (
    r"^응+$", r"^응응+$", r"^ㅇㅇ$", r"^좋아요?$", r"^해봐$", r"^진행해봐$", r"^그렇게 해봐$", r"^좋다$", r"^일단 대기해$",
    r"^응응 좋다 일단 대기해$", r"^여기있는거양$", r"^이거 맞아\??$",
)

# fixed values: paths and words of passing context
TEMPORARY_PARTS = ("/users/", ".jsonl", "/workspace", "/sessions", "tmp/", "file path")
TEMPORARY_WORDS = r"(?i)(^|\s)(session|sessions|workspace|jsonl|path)(\s|$)"

NO_USER_TEXT = "요약 가능한 user text 없음"


@dataclass(frozen=True)
class Lexicon:
    """What the heuristic looks for.  Patterns are regular expressions, terms lower-case substrings."""

    strong: tuple[str, ...]
    medium: tuple[str, ...]
    long_term: tuple[str, ...]
    decided: tuple[str, ...]
    preference: tuple[str, ...]
    actionable: tuple[str, ...]
    novel: tuple[str, ...]
    kinds: dict[str, tuple[str, ...]]
    gates: dict[str, tuple[str, ...]]
    automation: tuple[str, ...] = ("[cron:", "__cron", "task: 1) determine today's date", "do not read inbox_rules.md")
    automation_cwd: tuple[str, ...] = ("/00_blog",)
    weights: dict[str, int] = field(
        default_factory=lambda: {
            "explicitMemorySignal": 25, "longTermProjectSignal": 20, "decisionMadeSignal": 15, "userPreferenceSignal": 15,
            "actionableFollowupSignal": 10, "recurrenceSignal": 10, "noveltySignal": 5,
        }
    )


# fixed values: the default lexicon
DEFAULT = Lexicon(
    strong=("기억해", "앞으로", "규칙", "원칙", "선호", "매일", "cron", r"(?i)memory\.md", "(?i)supabase", r"새벽(?U)\s*2시", "(?i)dream"),
    medium=("프로젝트", "구현", "설계", "정리", "삭제", "보존", "(?i)archive", "(?i)promote", "(?i)retention"),
    long_term=("supabase", "memory", "아키텍처", "정책", "운영"),
    decided=("하자", "진행해보자", "그렇게 진행", "확정", "추천"),
    preference=("선호", "원해", "하지마", "하지 말", "좋아"),
    actionable=("다음 단계", "체크리스트", "sql", "runner"),
    novel=("dream memory", "자아", "기억 시스템"),
    kinds={
        "user_preference": ("선호", "말투", "호칭"), "project_state": ("프로젝트", "로드맵", "우선순위"),
        "operation_rule": ("규칙", "정책", "운영"), "decision": ("결정", "확정", "하자"),
    },
    gates={
        "operation_rule": ("규칙", "원칙", "앞으로", "반드시", "금지", "지침"), "decision": ("하자", "진행", "확정", "결정", "하자고", "하기로"),
        "project_state": ("프로젝트", "구현", "추가", "연결", "상태", "다음 단계", "붙였", "남은"),
        "fact": ("기억", "앞으로", "항상", "중요", "남겨", "기록", "원칙", "정책", "선호"),
    },
)

#: For tables of invented prose, where the default finds nothing.
PROSE = Lexicon(
    strong=("(?i)that", "thea"),
    medium=("(?i)with", "(?i)from", "ing", "tion"),
    long_term=("ened", "orth"),
    decided=("shon", "antion"),
    preference=("ouan", "what"),
    actionable=("inre", "esti"),
    novel=("ndon",),
    kinds={"user_preference": ("what", "ouan"), "project_state": ("ened", "thre"), "operation_rule": ("that", "wher"), "decision": ("shon", "andst")},
    gates={"operation_rule": ("the",), "decision": ("on", "an"), "project_state": ("ing", "er"), "fact": ("th", "st")},
    automation=("anstth",),
)
