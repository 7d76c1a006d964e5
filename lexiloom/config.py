"""Settings and vocabularies.

A vocabulary is configuration: small, ordered (the first matching entry wins)
and inlined into plans as a literal. ``lookup_terms`` in
``operators.vocabulary`` is the join-based form for large term tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TERM_KINDS = ("devices", "locations", "actions", "times")
LIST_KINDS = ("prefixes", "suffixes")

# The default Vietnamese smart-home vocabulary.
_DEVICES = {
    "máy lạnh": ["điều hòa", "máy điều hòa", "AC"],
    "điều hòa": ["máy lạnh", "máy điều hòa không khí"],
    "đèn": ["bóng đèn", "thiết bị chiếu sáng"],
    "bóng đèn": ["đèn", "đèn điện"],
    "đèn led": ["đèn LED", "bóng đèn LED"],
    "lò vi sóng": ["lò nướng", "máy nướng"],
    "tủ lạnh": ["tủ đông", "máy làm lạnh"],
    "máy rửa bát": ["máy rửa chén", "thiết bị rửa bát"],
    "tivi": ["ti vi", "TV", "màn hình tivi"],
    "radio": ["máy radio", "đài", "thiết bị phát thanh"],
    "quạt": ["máy quạt", "quạt điện"],
    "camera": ["máy quay", "thiết bị giám sát"],
}
_LOCATIONS = {
    "phòng ngủ": ["buồng ngủ", "phòng nghỉ"],
    "phòng khách": ["phòng tiếp khách", "sảnh", "phòng sinh hoạt"],
    "nhà bếp": ["bếp", "phòng bếp", "khu vực nấu ăn", "Khu vực ăn uống"],
    "nhà tắm": ["phòng tắm", "phòng vệ sinh", "toilet"],
    "phòng làm việc": ["văn phòng", "phòng học", "phòng đọc sách"],
    "garage": ["nhà xe", "ga ra", "chỗ để xe", "nhà để xe"],
    "sân": ["sân nhà", "khuôn viên"],
    "ban công": ["sân thượng", "hiên nhà"],
}
_ACTIONS = {
    "bật": ["mở", "kích hoạt", "khởi động", "bắt đầu"],
    "tắt": ["đóng", "ngắt", "dừng", "tắt đi"],
    "mở": ["bật", "kích hoạt", "khởi động"],
    "đóng": ["tắt", "ngắt", "dừng"],
    "tăng": ["nâng", "tăng lên", "điều chỉnh lên"],
    "giảm": ["hạ", "giảm xuống", "điều chỉnh xuống"],
    "kiểm tra": ["xem", "check", "tra cứu"],
    "điều chỉnh": ["thay đổi", "chỉnh sửa", "cài đặt"],
}
_TIMES = {
    "bây giờ": ["ngay bây giờ", "lúc này", "hiện tại"],
    "sau": ["sau đó", "tiếp theo", "kế tiếp"],
    "trước": ["trước đó", "lúc trước"],
    "sáng": ["buổi sáng", "sáng sớm"],
    "chiều": ["buổi chiều", "chiều tối"],
    "tối": ["buổi tối", "tối muộn"],
    "đêm": ["ban đêm", "đêm khuya"],
}
_PREFIXES = ["Làm ơn", "Xin hãy", "Bạn ơi", "Anh/chị ơi", "Giúp tôi", "Có thể"]
_SUFFIXES = ["nhé", "được không", "giúp tôi", "với", "được chứ", "nha", "đi"]

# Method names, in the order in which they are tried.
METHOD_ORDER = ("synonym_replacement", "politeness_addition", "sentence_restructuring", "time_variation")


@dataclass(frozen=True)
class Vocabulary:
    devices: dict[str, list[str]] = field(default_factory=dict)
    locations: dict[str, list[str]] = field(default_factory=dict)
    actions: dict[str, list[str]] = field(default_factory=dict)
    times: dict[str, list[str]] = field(default_factory=dict)
    prefixes: list[str] = field(default_factory=list)
    suffixes: list[str] = field(default_factory=list)

    def extended(self, kind: str, entries: dict[str, list[str]] | list[str]) -> "Vocabulary":
        """Entries added behind the existing ones (a known term gets new synonyms)."""
        if kind in TERM_KINDS:
            return replace(self, **{kind: {**getattr(self, kind), **entries}})
        if kind in LIST_KINDS:
            return replace(self, **{kind: [*getattr(self, kind), *entries]})
        raise ValueError(f"Unknown vocabulary kind: {kind}")


def default_vocabulary() -> Vocabulary:
    return Vocabulary(_DEVICES, _LOCATIONS, _ACTIONS, _TIMES, _PREFIXES, _SUFFIXES)


@dataclass(frozen=True)
class Settings:
    vocabulary: Vocabulary = field(default_factory=default_vocabulary)
    # rarity and generation
    min_intent_frequency: int = 100
    min_entity_frequency: int = 50
    augment_rare_intents: bool = True
    augment_rare_entities: bool = True
    methods: tuple[str, ...] = METHOD_ORDER
    max_variations: int = 3
    prefix_chance: float = 0.4
    suffix_chance: float = 0.6
    time_markers: tuple[str, ...] = ("lúc", "vào", "tại")
    place_markers: tuple[str, ...] = ("trong", "ở", "tại")
    seed: int = 0
    # False lets a synonym that is not yet in the sentence replace an entity
    require_present: bool = True
    # True keeps the words behind a moved time or place expression
    keep_tail: bool = False
    # quality gate
    min_length_ratio: float = 0.7
    max_length_ratio: float = 2.0
    check_entity_preservation: bool = True
    require_vietnamese_characters: bool = True
    # review and integration
    min_quality: float = 3.0
    min_naturalness: float = 3.0
    auto_approve_at: float = 4.0
    strategy: str = "balanced"
    preserve_original: bool = True
    add_metadata: bool = True
    output_format: str = "jsonl"


def load_settings(spark: SparkSession, path: str) -> Settings:
    """Settings from a YAML (or JSON) file on any file system Spark can read."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading a settings file needs the yaml package") from missing
    text = spark.read.text(path, wholetext=True).first()
    return settings_from(yaml.safe_load(text["value"]) if text else None)


def settings_from(document: dict | None) -> Settings:
    """Settings of a document; an empty one, a section without content and a value left blank keep the defaults."""
    document = document or {}
    words = document.get("vocabularies") or {}
    polite = words.get("politeness") or {}
    vocabulary = Vocabulary(
        *({term: list(synonyms or []) for term, synonyms in (words.get(kind) or {}).items()}
          for kind in ("devices", "locations", "actions", "time_expressions")),
        polite.get("prefixes") or [], polite.get("suffixes") or [],
    ) if words else default_vocabulary()
    generate, quality, merge = (document.get(section) or {} for section in ("augmentation", "quality_control", "integration"))
    given = {
        "min_intent_frequency": generate.get("min_intent_frequency"),
        "min_entity_frequency": generate.get("min_entity_frequency"),
        "augment_rare_intents": generate.get("augment_rare_intents"),
        "augment_rare_entities": generate.get("augment_rare_entities"),
        "max_variations": generate.get("max_variations_per_sample"),
        **{name: generate.get(name) for name in ("prefix_chance", "suffix_chance", "seed", "require_present", "keep_tail")},
        **{name: tuple(generate.get(name) or ()) or None for name in ("time_markers", "place_markers")},
        "min_quality": quality.get("min_quality_score"),
        "min_naturalness": quality.get("min_naturalness_score"),
        "methods": tuple(generate.get("sample_augmentation_methods") or ()) or None,
        "min_length_ratio": quality.get("min_length_ratio"),
        "max_length_ratio": quality.get("max_length_ratio"),
        "check_entity_preservation": quality.get("check_entity_preservation"),
        "require_vietnamese_characters": quality.get("require_vietnamese_characters"),
        "auto_approve_at": quality.get("auto_approve_threshold"),
        "strategy": merge.get("strategy"),
        "preserve_original": merge.get("preserve_original_data"),
        "add_metadata": merge.get("add_augmentation_metadata"),
        "output_format": merge.get("output_format"),
    }
    return Settings(vocabulary=vocabulary, **{k: v for k, v in given.items() if v is not None})


def vocabulary_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """One row per entry: kind, position within the kind, term, synonyms."""
    rows = [(kind, i, term, list(synonyms))
            for kind in TERM_KINDS
            for i, (term, synonyms) in enumerate(getattr(vocabulary, kind).items())]
    rows += [(kind, i, phrase, [])
             for kind in LIST_KINDS
             for i, phrase in enumerate(getattr(vocabulary, kind))]
    return spark.createDataFrame(rows, "kind string, ord int, original string, synonyms array<string>")


def vocabulary_from(table: DataFrame) -> Vocabulary:
    """The vocabulary held by a table shaped like ``vocabulary_table``'s."""
    kinds: dict[str, list] = {kind: [] for kind in TERM_KINDS + LIST_KINDS}
    for row in table.orderBy("kind", "ord").collect():
        kinds[row["kind"]].append((row["original"], list(row["synonyms"] or [])))
    return Vocabulary(**{
        kind: dict(entries) if kind in TERM_KINDS else [term for term, _ in entries]
        for kind, entries in kinds.items()
    })


def literal(value, ddl: str) -> Column:
    """A nested constant; the optimizer folds the parsing away."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def entries_literal(terms: dict[str, list[str]], **extra: Callable[[str], str]) -> Column:
    """Terms as a constant ``array<struct<original, synonyms, …>>`` in vocabulary order.

    Each keyword adds a string field computed from the term.
    """
    entries = [{"original": term, "synonyms": list(synonyms), **{name: make(term) for name, make in extra.items()}}
               for term, synonyms in terms.items()]
    fields = "".join(f",{name}:string" for name in extra)
    return literal(entries, f"array<struct<original:string,synonyms:array<string>{fields}>>")
