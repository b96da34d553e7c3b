"""Preset for the news-article table: families, domains and cleaning settings."""

from __future__ import annotations

from plumbline.operators import checks
from plumbline.operators.calibrate import CalibrationConfig
from plumbline.operators.impute import ImputePolicy
from plumbline.operators.rules import (
    AbsOf, AnyFlag, NullNegative, NullOutside, Rule, Simplex, SingleOne, SnapBinary)
from plumbline.plans.families import ColumnFamilies, Family

# The column names of the article table, by family.
KEY = "url"
TARGET = "shares"
TOPICS = tuple(f"LDA_{i:02d}" for i in range(5))
CHANNELS = tuple(f"data_channel_is_{c}" for c in ("lifestyle", "entertainment", "bus", "socmed", "tech", "world"))
WEEKDAYS = tuple(f"weekday_is_{d}" for d in (
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"))
WEEKEND = ("is_weekend", "weekday_is_saturday", "weekday_is_sunday")
KEYWORDS = tuple(f"kw_{a}_{b}" for b in ("min", "max", "avg", "total") for a in ("min", "max", "avg"))
SENTINEL_KEYWORDS = ("kw_min_min", "kw_avg_min", "kw_min_avg")
RATES = ("global_rate_positive_words", "global_rate_negative_words", "rate_positive_words", "rate_negative_words")
SUBJECTIVITY = ("global_subjectivity", "title_subjectivity", "abs_title_subjectivity")
POSITIVE = ("avg_positive_polarity", "min_positive_polarity", "max_positive_polarity")
NEGATIVE = ("avg_negative_polarity", "min_negative_polarity", "max_negative_polarity")
SIGNED = ("global_sentiment_polarity", "title_sentiment_polarity")
ABS_POLARITY = ("abs_title_sentiment_polarity", "title_sentiment_polarity")
SELF_REFERENCE = ("self_reference_min_shares", "self_reference_max_shares", "self_reference_avg_sharess")
TOKEN_SHARES = ("n_unique_tokens", "n_non_stop_words", "n_non_stop_unique_tokens")
COUNTS = ("n_tokens_title", "n_tokens_content", "num_hrefs", "num_self_hrefs", "num_imgs", "num_videos",
          "num_keywords", "average_token_length")
AGE = "timedelta"
AGE_RANGE = (8.0, 731.0)
PRUNED = ("average_token_length", "kw_avg_min", "kw_avg_max", "kw_avg_avg", "avg_positive_polarity",
          "avg_negative_polarity", *SELF_REFERENCE, "timedelta", "is_weekend", "weekday_is_sunday", "mixed_type_col")

FLAGS = CHANNELS + WEEKDAYS + ("is_weekend",)

FAMILIES = ColumnFamilies({
    "key": Family(names=(KEY,)),
    "topic": Family(prefixes=("LDA_",)),
    "channel": Family(prefixes=("data_channel_is_",)),
    "weekday": Family(prefixes=("weekday_is_",), names=("is_weekend",)),
    "keyword": Family(prefixes=("kw_",)),
    "rate": Family(names=RATES),
    "subjectivity": Family(names=SUBJECTIVITY),
    "positive_polarity": Family(names=POSITIVE),
    "negative_polarity": Family(names=NEGATIVE),
    "signed_polarity": Family(names=SIGNED),
    "self_reference": Family(prefixes=("self_reference_",)),
    "count": Family(prefixes=("n_tokens_", "num_"), names=("average_token_length",)),
}, rest="other")


def enforcement_rules(columns: list[str], repairs: bool = True) -> list[Rule]:
    """Domain rules in order: ranges before shares, snapping before flags.

    ``repairs=False`` leaves out the absolute-value and one-hot repairs and
    bounds the absolute polarity instead.
    """
    counts = tuple(c for c in columns if c.startswith(("n_tokens_", "num_"))) + ("average_token_length",)
    keywords = tuple(c for c in columns if c.startswith("kw_")) if repairs else SENTINEL_KEYWORDS
    rules: list[Rule] = [
        NullNegative("keyword_negative", keywords),
        NullNegative("count_negative", tuple(dict.fromkeys(counts))),
    ]
    if repairs:
        rules.append(NullNegative("self_reference_negative", SELF_REFERENCE))
    rules += [
        NullOutside("share_outside_0_1", RATES + SUBJECTIVITY + POSITIVE + TOPICS, 0.0, 1.0),
        NullOutside("negative_polarity_outside", NEGATIVE, -1.0, 0.0),
        NullOutside("signed_polarity_outside", SIGNED if repairs else SIGNED + ABS_POLARITY[:1], -1.0, 1.0),
    ]
    if repairs:
        rules.append(AbsOf("absolute_polarity", ABS_POLARITY))
    rules.append(SnapBinary("flag_snapped", FLAGS))
    if repairs:
        rules += [SingleOne("weekday_single", WEEKDAYS), SingleOne("channel_single", CHANNELS)]
    rules += [
        AnyFlag("weekend_realigned", WEEKEND),
        Simplex("topic_renormalised", TOPICS),
        NullOutside("age_outside", (AGE,), *AGE_RANGE),
    ]
    return rules


def imputation_policy(columns: list[str], every_column: bool = True) -> ImputePolicy:
    """``every_column`` fills all remaining numbers; otherwise the sentinel keywords and
    columns outside the families stay missing."""
    bounded = ((0.0, 1.0, RATES + SUBJECTIVITY + POSITIVE), (-1.0, 0.0, NEGATIVE), (-1.0, 1.0, SIGNED + ABS_POLARITY[:1]))
    handled = {KEY, *TOPICS, *FLAGS, *(c for _, _, cs in bounded for c in cs)}
    if every_column:
        median = tuple(c for c in columns if c not in handled)
    else:
        median = (*COUNTS, *TOKEN_SHARES, *SELF_REFERENCE, TARGET, AGE,
                  *(c for c in KEYWORDS if c not in SENTINEL_KEYWORDS))
    return ImputePolicy(median=median, mode=FLAGS, flags=(WEEKEND,), simplex=TOPICS, bounded=bounded)


def calibration_config(k: float = 3.0, k_target: float = 4.0, counts: tuple[str, ...] = COUNTS,
                       keywords: tuple[str, ...] = SENTINEL_KEYWORDS) -> CalibrationConfig:
    return CalibrationConfig(
        zclip=(("zclip_counts", counts, k), ("zclip_keywords", keywords, k), ("zclip_target", (TARGET,), k_target)),
        clips=(("share_clipped", 0.0, 1.0, RATES + SUBJECTIVITY + POSITIVE + TOKEN_SHARES),),
        simplex=TOPICS)


def reconstruction_config() -> CalibrationConfig:
    """One width for tokens, target and sentinel keywords, then token shares into 0..1."""
    tokens = ("n_tokens_title", "n_tokens_content", *TOKEN_SHARES, "num_hrefs", "num_self_hrefs", "num_imgs",
              "num_videos")
    return CalibrationConfig(zclip=(("zclip", (*tokens, TARGET, *SENTINEL_KEYWORDS), 3.0),),
                             clips=(("share_clipped", 0.0, 1.0, TOKEN_SHARES),))


def final_config() -> CalibrationConfig:
    """Rescue of mis-scaled shares, domain clips, then z-clips; fit it on a sanitised reference."""
    return CalibrationConfig(
        zclip=(("zclip_counts", COUNTS + SENTINEL_KEYWORDS, 3.0), ("zclip_target", (TARGET,), 4.0)),
        rescue=TOKEN_SHARES + RATES + SUBJECTIVITY,
        clips=(("positive_clipped", 0.0, 1.0, POSITIVE), ("negative_clipped", -1.0, 0.0, NEGATIVE),
               ("signed_clipped", -1.0, 1.0, SIGNED)),
        simplex=TOPICS, rescue_first=True)


# Domains and heavy-tailed columns of the reference, for ``sanitised_reference``.
REFERENCE_DOMAINS = ((0.0, 1.0, TOKEN_SHARES + RATES + SUBJECTIVITY + POSITIVE), (-1.0, 0.0, NEGATIVE),
                     (-1.0, 1.0, SIGNED))
REFERENCE_HEAVY = COUNTS + SENTINEL_KEYWORDS + (TARGET,)
REFERENCE_NULL_ABOVE = (("n_unique_tokens", 1.0),)


def violation_checks(columns: list[str]) -> list[checks.Check]:
    present = set(columns)

    def have(names):
        return [c for c in names if c in present]

    families = FAMILIES.resolve(columns, [c for c in columns if c != KEY])
    plain_keywords = [c for c in families["keyword"] if c not in SENTINEL_KEYWORDS]
    found = (checks.negatives("negative", have((*families["other"], *SELF_REFERENCE, *families["count"])) + plain_keywords)
             + checks.outside("age_outside", have((AGE,)), *AGE_RANGE)
             + checks.negatives("sentinel_negative", have(SENTINEL_KEYWORDS)))
    return found + _domain_checks(columns) + _consistency_checks(columns)


def domain_checks(columns: list[str]) -> list[checks.Check]:
    """Range rules only: what may be left out of domain after enforcement."""
    return _domain_checks(columns)


def constraint_rules(columns: list[str]) -> list[checks.Check]:
    present = set(columns)
    rules = _domain_checks(columns) + checks.not_binary("flag_not_binary", [c for c in FLAGS if c in present])
    if set(TOPICS) <= present:
        rules += checks.row_sum_off("topic_sum", TOPICS)
    return rules


def _domain_checks(columns):
    def have(names):
        return [c for c in names if c in columns]

    return (checks.outside("topic_outside_0_1", have(TOPICS), 0.0, 1.0)
            + checks.outside("share_outside_0_1", have(RATES + SUBJECTIVITY), 0.0, 1.0)
            + checks.outside("positive_polarity_outside", have(POSITIVE), 0.0, 1.0)
            + checks.outside("negative_polarity_outside", have(NEGATIVE), -1.0, 0.0)
            + checks.outside("signed_polarity_outside", have(SIGNED), -1.0, 1.0))


def _consistency_checks(columns):
    present = set(columns)
    found = checks.not_binary("flag_not_binary", [c for c in FLAGS if c in present])
    if set(TOPICS) <= present:
        found += checks.row_sum_off("topic_sum", TOPICS)
    if set(ABS_POLARITY) <= present:
        found += checks.abs_mismatch("absolute_polarity", *ABS_POLARITY)
    weekdays = [c for c in WEEKDAYS if c in present]
    channels = [c for c in CHANNELS if c in present]
    if len(weekdays) >= 5:
        found += checks.not_exactly_one("weekday_exactly_one", weekdays)
    if len(channels) >= 2:
        found += checks.more_than_one("channel_at_most_one", channels)
    if set(WEEKEND) <= present:
        found += checks.flag_mismatch("weekend_consistency", WEEKEND[0], WEEKEND[1:])
    return found
