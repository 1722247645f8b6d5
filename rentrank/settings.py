"""Fixed values and job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# --- Fixed values: results depend on them being exactly these. -------------

IGNORE_KEYWORDS = ("ignore", "delete", "d")
FAVOURITE_KEYWORDS = ("favourite", "keep", "f")
MESSAGED_KEYWORDS = ("messaged", "m")

STATUS_KEYWORDS = {
    "ignored": IGNORE_KEYWORDS,
    "favourites": FAVOURITE_KEYWORDS,
    "messaged": MESSAGED_KEYWORDS,
}

SCORE_WEIGHTS = {
    "direct_line_to_office": 1,
    "location_1": 6,
    "location_2": 6,
    "minimum_term": 1,
    "bills_included": 4,
    "broadband_included": 1,
    "garden_or_patio": 1,
    "living_room": 3,
    "balcony_or_rooftop_terrace": 1,
    "total_number_of_rooms": 2,
    "gender": 1,
    "average_price": 5,
    "furnishings": 2,
    "collective_word_count": 8,
    "preferable_poster_type": 1,
}

BOOL_METRICS = (
    "direct_line_to_office",
    "bills_included",
    "broadband_included",
    "furnishings",
    "garden_or_patio",
    "living_room",
    "balcony_or_rooftop_terrace",
    "preferable_poster_type",
)

RANGE_METRICS = {
    "location_1": (20, 60),
    "location_2": (20, 60),
    "minimum_term": (0, 12),
    "total_number_of_rooms": (2, 6),
    "average_price": (700, 1000),
    "collective_word_count": (0, 7),
}

# A larger value is better only for these; every other range is inverted.
RISING_METRICS = ("collective_word_count",)

TRUE_WORDS = ("furnished", "yes", "shared", "some")
FALSE_WORDS = ("unfurnished", "no")

COLLECTIVE_WORDS = ("we", "us", "our", "ours", "together", "household", "home", "shared", "sharing")

PART_WEEK_NOTICES = ("Room available Monday to Friday only", "Room available weekends only")

JUBILEE_STATIONS = (
    "Stanmore", "Canons Park", "Queensbury", "Kingsbury", "Wembley Park", "Neasden",
    "Dollis Hill", "Willesden Green", "Kilburn", "West Hampstead", "Finchley Road",
    "Swiss Cottage", "St. John's Wood", "Baker Street", "Bond Street", "Green Park",
    "Westminster", "Waterloo", "Southwark", "London Bridge", "Bermondsey", "Canada Water",
    "Canary Wharf", "North Greenwich", "Canning Town", "West Ham", "Stratford",
)

ELIZABETH_STATIONS = (
    "Reading", "Twyford", "Maidenhead", "Taplow", "Burnham", "Slough", "Langley", "Iver",
    "West Drayton", "Hayes & Harlington", "Southall", "Hanwell", "West Ealing",
    "Ealing Broadway", "Acton Main Line", "Paddington", "Bond Street",
    "Tottenham Court Road", "Farringdon", "Liverpool Street", "Whitechapel",
    "Canary Wharf", "Custom House", "Woolwich", "Abbey Wood", "Stratford", "Maryland",
    "Forest Gate", "Manor Park", "Ilford", "Seven Kings", "Goodmayes", "Chadwell Heath",
    "Romford", "Gidea Park", "Harold Wood", "Brentwood", "Shenfield",
)

# --- End of fixed values. ---------------------------------------------------

DIRECT_LINE_STATIONS = tuple(dict.fromkeys(JUBILEE_STATIONS + ELIZABETH_STATIONS))

RESULTS_PER_PAGE = 10


@dataclass(frozen=True)
class JobConfig:
    """Parameters of one run.

    ``run_date`` replaces "today", so that a re-run of the same input gives the same rows.
    """

    run_date: date
    domain: str
    number_of_pages: int = 20
    min_rent: int = 200
    max_rent: int = 1000
    check_expired: bool = False
    update_only: bool = False
    commute_enabled: bool = True
    dedupe_by_id: bool = False
    anchors: tuple[int, ...] = (1, 2)
    weights: dict = field(default_factory=lambda: dict(SCORE_WEIGHTS))
    status_keywords: dict = field(default_factory=lambda: dict(STATUS_KEYWORDS))
    show_favourites: bool = True
    show_new_listings: bool = True
    min_marker_score: float = 15
    keep_versions: int | None = None  # of each rewritten table; None keeps all

    def __post_init__(self) -> None:
        if self.number_of_pages < 0:
            raise ValueError("number_of_pages must not be negative")
        if self.min_rent > self.max_rent:
            raise ValueError("min_rent must not exceed max_rent")
        if self.keep_versions is not None and self.keep_versions < 1:
            raise ValueError("keep_versions must be at least 1")

    @property
    def pages_to_read(self) -> int:
        return 0 if self.update_only else self.number_of_pages
