"""Rules and per-run parameters. Everything here is small and lives on the driver."""

from __future__ import annotations

import copy
from dataclasses import dataclass, field
from datetime import datetime, timedelta

# The category labels ("streams") in digest order.
STREAMS = ("ai_digital", "culture_family", "concert")

# City names recognised inside a longer place text, in matching order.
KNOWN_CITIES = (
    "gdansk", "gdynia", "sopot", "trojmiasto", "warszawa", "krakow",
    "wroclaw", "poznan", "katowice", "lodz",
)

# City names that count as the home area.
HOME_CITIES = ("gdansk", "gdynia", "sopot", "trojmiasto")

# Fixed value: trust of a source that the rules do not list.
DEFAULT_TRUST = 0.5

# The default rule set (thresholds, keyword lists, weights).
_DEFAULT_RULES = {
    "date_window_days": 14,
    "concert_window_days": 30,
    "national_concert_window_days": 365,
    "max_per_stream": 0,
    "fetch_budget_per_run": 30,
    "empty_run_message": True,
    "tricity_surroundings": [
        "gdansk", "gdynia", "sopot", "trojmiasto", "pruszcz gdanski",
        "rumia", "reda", "wejherowo", "tczew",
    ],
    "major_cities": [
        "warszawa", "krakow", "wroclaw", "poznan", "katowice", "lodz", "gdansk", "gdynia",
    ],
    "large_event": {
        "min_days": 2,
        "known_brands": [
            "infoshare", "code europe", "4developers", "data science summit",
            "the hack summit", "pyconpl", "devoxx",
        ],
    },
    "world_class": {
        "large_venues": [
            "ergo arena", "tauron arena", "pge narodowy", "atlas arena", "spodek",
            "torwar", "stadion", "narodowy", "stadion energa",
        ],
        "allowlist": [
            "sting", "metallica", "coldplay", "dua lipa", "imagine dragons",
            "ed sheeran", "the weeknd", "rammstein", "guns n roses",
        ],
        "trusted_sources": ["ebilet", "livenation"],
    },
    "exclusions": {
        "keywords": [
            "mecz", "ekstraklasa", "ligowy", "ligowa", "ligowe", "puchar polski",
            "kolejka ligi", "sparing", "derby", " liga ", "rozgrywki",
        ],
        "subcategories": ["sport", "pilka nozna", "football", "mecze"],
        "adult_only": ["18+", "tylko dla doroslych", "strip", "adults only"],
    },
    "family": {
        "kids_keywords": [
            "dla dzieci", "rodzinny", "rodzinne", "bajka", "familijny", "maluch",
            "spektakl dla dzieci", "teatr dla dzieci", "warsztaty dla dzieci",
            "ferie", "animacje", "gry i zabawy", "park rozrywki",
        ],
    },
    "classify": {
        "ai_digital": [
            "ai", "ml", "sztuczna inteligencja", "machine learning", "deep learning",
            "llm", "genai", "agentic", "rag", "gemini", "copilot", "data", "dane",
            "analityka", "analytics", "data engineering", "data science", "bigquery",
            "python", "hackathon", "hackerspace", "devops", "mlops", "cloud", "aws",
            "programowanie", "developer", "tech", "digital", "marketing", "product",
            "produkt", "produktowe", "ux", "startup", "saas", "no-code", "automatyzacj",
        ],
        "concert": [
            "koncert", "concert", "trasa", "tour", "live", "unplugged", "recital",
            "dj set", "festiwal muzyczny",
        ],
        "culture_family": [
            "spektakl", "teatr", "wystawa", "dla dzieci", "rodzinny", "warsztaty",
            "festiwal", "musical", "bal", "kabaret", "stand-up", "wycieczka",
        ],
    },
    "scoring": {
        "date_proximity_weight": 1.0,
        "topical_match_weight": 1.0,
        "source_trust_weight": 0.5,
    },
    "source_trust": {
        "crossweb": 0.9, "trojmiasto": 0.85, "ebilet": 0.8,
        "ticketmaster": 0.85, "evenea": 0.7, "going": 0.6,
    },
}

# Family keywords used when the rules give none.
FALLBACK_KIDS_KEYWORDS = (
    "dla dzieci", "rodzinny", "rodzinne", "bajka", "familijny", "maluch",
)


def default_rules() -> dict:
    """A fresh copy of the default rule set."""
    return copy.deepcopy(_DEFAULT_RULES)


def load_rules(path: str) -> dict:
    """Read a rule file (YAML where the reader is installed, else JSON)."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    try:
        import yaml
    except ImportError:
        import json

        return json.loads(text)
    return yaml.safe_load(text)


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one run. ``run_ts`` is Warsaw wall-clock time; no stage reads a clock.

    ``window_days`` and ``max_per_stream`` override the rules when they are not ``None``
    (0 is a value). ``max_per_stream <= 0`` means no cap. ``fold_stroke`` folds the stroked l.
    ``similar_titles`` (such as 0.8) also collapses events of one day and place whose titles are that similar.
    """

    run_ts: datetime
    rules: dict = field(default_factory=default_rules)
    streams: tuple[str, ...] = STREAMS
    window_days: int | None = None
    max_per_stream: int | None = None
    deliver_unchanged: bool = False
    inclusive_last_day: bool = False
    run_id: str | None = None
    fold_stroke: bool = False
    similar_titles: float | None = None

    @property
    def fetch_budget(self) -> int:
        """The budget, under its own key or the one of existing rule files."""
        rules = self.rules
        return rules.get("fetch_budget_per_run", rules.get("firecrawl_budget_per_run", 0))

    @property
    def date_window_days(self) -> int:
        return self.rules["date_window_days"] if self.window_days is None else self.window_days

    @property
    def concert_window_days(self) -> int:
        return self.rules.get("concert_window_days", self.date_window_days)

    @property
    def national_window_days(self) -> int:
        return self.rules["national_concert_window_days"]

    @property
    def cap(self) -> int:
        return self.rules["max_per_stream"] if self.max_per_stream is None else self.max_per_stream

    @property
    def resolved_run_id(self) -> str:
        return self.run_id or self.run_ts.strftime("%Y%m%d-%H%M%S")

    @property
    def window_label(self) -> str:
        last = self.run_ts + timedelta(days=self.date_window_days)
        return (
            f"najblizsze {self.date_window_days} dni ({self.run_ts:%d.%m}-{last:%d.%m.%Y}), "
            f"koncerty do {self.concert_window_days} dni"
        )
