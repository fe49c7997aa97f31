"""Settings: what scoring weighs, and which parts a batch runs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ScoringProfile:
    """Weights and modes of the rule model. `tld_mode` and `flat_reputation` choose between the documented behaviour and
    the published one: suffix sets that never match, and a second pass that ignores content diversity."""

    # fixed values: weights of the rule model
    risk: dict[str, float] = field(
        default_factory=lambda: {
            "has_ip_address": 2.5, "suspicious_tld": 0.8, "is_url_shortener": 0.5, "contains_phishing": 3.0, "contains_download": 1.0,
            "is_malformed_url": 3.0, "domain_is_numeric_heavy": 0.8, "is_nsfw_content": 1.5, "is_spam_content": 1.2, "is_nsfw_domain": 2.5,
            "path_keyword_stuffing": 1.5, "is_media_or_api": 0.7, "very_short_url": 0.5, "no_scheme": 0.3, "has_invalid_timestamp": 0.5,
            "domain_hyphen_heavy": 0.5, "excessive_params": 0.6, "suspicious_chars_path": 0.7, "excessive_encoding": 0.6, "is_ugc_path": 0.4,
        }
    )
    priority: dict[str, float] = field(default_factory=lambda: {"trustworthy_tld": 1.2, "is_quality_domain": 0.8, "is_news_domain": 1.2})
    spam_below: float = -1.8
    reputation_weight: float = 0.2
    tld_mode: str = "documented"
    flat_reputation: bool = False
    max_len: int = 1000


DEFAULT = ScoringProfile()
AS_PUBLISHED = ScoringProfile(tld_mode="as_published", flat_reputation=True)


@dataclass(frozen=True)
class PipelineConfig:
    """Which models and sinks a batch runs, and how large its deep-feature sample is."""

    methods: tuple[str, ...] = ("rules",)
    profile: ScoringProfile = DEFAULT
    use_curated: bool = False
    use_lists: bool = False
    read_reputation: bool = True
    write_reputation: bool = True
    write_parquet: bool = True
    write_tsv: bool = False
    write_summary: bool = False
    use_features: bool = False
    max_sample: int = 6500
    sample_fraction: float = 1.0
    sample_seed: str = "42"
    write_db: bool = False
    train_model: bool = False
    base_every: int = 10
    store_buckets: int = 200
