"""Default parameters. Every operator takes its own lists as arguments; these are only the defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: topic keywords and ordered topic rules (first hit wins) -------------------------------------

GENERAL_KEYWORDS = (
    "hurricane",
    "helene",
    "milton",
    "irma",
    "harvey",
    "maria",
    "wildfire",
    "flood",
    "earthquake",
    "tornado",
    "evacuation",
    "storm surge",
)

STORM_KEYWORDS = (
    "hurricane",
    "helene",
    "milton",
    "irma",
    "harvey",
    "maria",
    "jose",
    "puerto rico",
)

# --- Fixed values: case-sensitive substrings counted on raw lines ------------------------------------------------

RAW_DEVICES = ("Twitter for iPhone", "Twitter for Android", "Twitter for iPad", "Twitter Web Client")
RAW_EVENTS = ("Hurricane", "Irma", "Harvey", "Maria", "Jose", "PuertoRico")

# --- Fixed values: affect names in listed order ------------------------------------------------------------------

AFFECTS = (
    "anger",
    "anticipation",
    "disgust",
    "fear",
    "joy",
    "sadness",
    "surprise",
    "trust",
    "positive",
    "negative",
)

# --- Fixed values: annotation flag columns -----------------------------------------------------------------------

HUMANITARIAN_FLAGS = ("Casualty", "Evacuation", "Damage", "Advice", "Request", "Assistance", "Recovery")
BIAS_FLAGS = ("Linguistic_Bias", "Political_Bias", "Gender_Bias", "Hate_Speech", "Racial_Bias")
DELETED_AUTHOR = "[deleted]"


@dataclass(frozen=True)
class LabelRules:
    """Ordered (label, keywords) rules, then a fallback list, then the default label."""

    rules: tuple[tuple[str, tuple[str, ...]], ...]
    fallback: tuple[str, ...] = ()
    fallback_label: str = "general"
    default: str = "other"


# The topic rules.
TOPIC_RULES = LabelRules(
    rules=(
        ("hurricane", STORM_KEYWORDS),
        ("wildfire", ("wildfire", "fire", "smoke", "evacuation")),
        ("flood", ("flood", "flooding", "storm surge", "inundation")),
        ("earthquake", ("earthquake", "seismic", "tremor", "aftershock")),
        ("tornado", ("tornado", "twister", "funnel cloud")),
    ),
    fallback=GENERAL_KEYWORDS,
    fallback_label="disaster_general",
)


# --- Fixed values: word lists and weights of the published rule-based sentiment model (Hutto & Gilbert 2014) -----

NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont "
    "hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt "
    "needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't "
    "shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite"
).split()

BOOSTERS_UP = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously "
    "entirely especially exceptional exceptionally extreme extremely fabulously flipping flippin frackin fracking "
    "fricking frickin frigging friggin fully fuckin fucking fuggin fugging greatly hella highly hugely incredible "
    "incredibly intensely major majorly more most particularly purely quite really remarkably so substantially "
    "thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very"
).split()

BOOSTERS_DOWN = (
    "almost barely hardly kinda kindof kind-of less little marginal marginally occasional occasionally partly "
    "scarce scarcely slight slightly somewhat sorta sortof sort-of"
).split()

BOOSTER_PHRASES_DOWN = ("just enough", "kind of", "sort of")

IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "bus stop": 0.0,
    "yeah right": -2.0,
    "kiss of death": -1.5,
    "to die for": 3.0,
    "beating heart": 3.1,
    "broken heart": -2.9,
}


@dataclass(frozen=True)
class SentimentRules:
    """Weights and word lists of the rule-based scorer."""

    boosters_up: tuple[str, ...] = tuple(BOOSTERS_UP)
    boosters_down: tuple[str, ...] = tuple(BOOSTERS_DOWN)
    booster_phrases_down: tuple[str, ...] = BOOSTER_PHRASES_DOWN
    negations: tuple[str, ...] = tuple(NEGATIONS)
    negation_part: str = "n't"
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))
    contrast: str = "but"
    no_word: str = "no"
    no_links: tuple[str, ...] = ("or", "nor")
    never: str = "never"
    never_links: tuple[str, ...] = ("so", "this")
    doubt: tuple[str, str] = ("without", "doubt")
    least: str = "least"
    least_lead: tuple[str, ...] = ("at", "very")
    not_a_booster: tuple[str, str] = ("kind", "of")
    #: Words that symbols of one character, such as emoji, are read as.
    symbols: dict[str, str] = field(default_factory=dict)

    booster_weight: float = 0.293
    caps_weight: float = 0.733
    negation_weight: float = -0.74
    never_weight: float = 1.25
    second_word_share: float = 0.95
    third_word_share: float = 0.9
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    exclamation_weight: float = 0.292
    exclamation_most: int = 4
    question_weight: float = 0.18
    question_most: int = 3
    question_top: float = 0.96
    alpha: float = 15.0


SENTIMENT_RULES = SentimentRules()
POSITIVE_FROM = 0.05
NEGATIVE_UPTO = -0.05

# A small seed so that the jobs run without a user's lexicon; valences on the usual -4..4 scale.
SEED_VALENCES = {
    "safe": 1.9,
    "help": 1.7,
    "helped": 1.8,
    "thank": 1.5,
    "thanks": 1.9,
    "good": 1.9,
    "great": 3.1,
    "love": 3.2,
    "hope": 1.9,
    "hopeful": 2.3,
    "relief": 2.1,
    "rescued": 1.8,
    "strong": 2.3,
    "no": -1.2,
    "bad": -2.5,
    "terrible": -2.1,
    "awful": -2.0,
    "sad": -2.1,
    "fear": -2.2,
    "scared": -1.9,
    "destroyed": -2.2,
    "damage": -2.2,
    "dead": -3.3,
    "lost": -1.3,
    "danger": -2.4,
    "worried": -1.2,
    "devastating": -2.6,
}

SEED_AFFECTS = {
    "safe": ("joy", "trust", "positive"),
    "help": ("trust", "positive"),
    "hope": ("anticipation", "joy", "surprise", "trust", "positive"),
    "love": ("joy", "positive"),
    "good": ("anticipation", "joy", "surprise", "trust", "positive"),
    "rescue": ("anticipation", "joy", "surprise", "trust", "positive"),
    "storm": ("anger", "negative"),
    "hurricane": ("fear", "negative"),
    "flood": ("fear",),
    "earthquake": ("anger", "fear", "sadness", "surprise", "negative"),
    "tornado": ("fear",),
    "evacuation": ("fear", "negative"),
    "fire": ("fear",),
    "danger": ("fear", "sadness", "negative"),
    "dead": ("anger", "disgust", "fear", "sadness", "negative"),
    "damage": ("anger", "disgust", "sadness", "negative"),
    "lost": ("sadness", "negative"),
    "scared": ("fear", "negative"),
    "bad": ("anger", "disgust", "fear", "sadness", "negative"),
}
