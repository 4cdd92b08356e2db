"""Rule packs: the configuration that enrichment, candidate scans and scoring take, and their validation."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from typing import Any


@dataclass(frozen=True)
class SignalRule:
    signal_type: str
    phrase: str
    needs_topic: bool = False


@dataclass(frozen=True)
class EntityRule:
    entity_type: str
    phrase: str


@dataclass(frozen=True)
class EnrichPack:
    version: str
    signals: tuple[SignalRule, ...]
    entities: tuple[EntityRule, ...]


@dataclass(frozen=True)
class CandidatePack:
    version: str
    minimum_length: int
    excluded: tuple[str, ...]
    priors: tuple[str, ...]
    groups: dict[str, tuple[str, ...]]

    def __post_init__(self) -> None:
        if not self.version or not self.groups or self.minimum_length < 0:
            raise ValueError("a candidate pack needs a version, groups and a minimum length of 0 or more")
        for name, terms in self.groups.items():
            if not name or not terms or len(set(terms)) != len(terms):
                raise ValueError(f"group {name!r} needs terms, each once")


@dataclass(frozen=True)
class Proximity:
    name: str
    anchors: tuple[str, ...]
    evidence: tuple[str, ...]
    window: int
    weight: float

    def __post_init__(self) -> None:
        if not self.anchors or not self.evidence or not 1 <= self.window <= 50 or not 0 < self.weight <= 1:
            raise ValueError(f"proximity rule {self.name!r} needs anchors, evidence, a window of 1 to 50 and a weight in (0, 1]")


@dataclass(frozen=True)
class DomainRules:
    name: str
    prior_weight: float
    groups: dict[str, float]
    required_terms: tuple[str, ...] = ()
    required_groups: tuple[str, ...] = ()
    minimum_groups: int = 0
    context: dict[str, float] = field(default_factory=dict)
    penalties: dict[str, float] = field(default_factory=dict)
    proximity: tuple[Proximity, ...] = ()

    def __post_init__(self) -> None:
        weights = [*self.groups.values(), *self.context.values(), *self.penalties.values()]
        if not self.groups or any(not 0 < w <= 1 for w in weights) or not 0 <= self.prior_weight <= 1:
            raise ValueError(f"domain {self.name!r}: weights must be in (0, 1]")
        if unknown := set(self.required_groups) - set(self.groups):
            raise ValueError(f"domain {self.name!r}: required groups without weight: {sorted(unknown)}")


@dataclass(frozen=True)
class RelevancePack:
    version: str
    tiers: tuple[float, float, float]
    domains: tuple[DomainRules, ...]
    signal_of_group: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        a, b, c = self.tiers
        if not 1 >= a > b > c > 0 or not self.domains or len({d.name for d in self.domains}) != len(self.domains):
            raise ValueError("tiers must fall from at most 1 to above 0, and domains must be unique")


def fingerprint(pack: Any) -> str:
    """SHA-256 of a pack, whatever the order in which its maps were written."""
    return hashlib.sha256(json.dumps(asdict(pack), sort_keys=True).encode()).hexdigest()


def load(path: str, kind: type) -> Any:
    """A pack from a YAML file; unknown fields are an error."""
    import yaml

    with open(path) as text:
        return build(yaml.safe_load(text), kind)


def build(raw: dict[str, Any], kind: type) -> Any:
    raw = dict(raw)
    if kind is EnrichPack:
        raw["signals"] = tuple(SignalRule(**r) for r in raw["signals"])
        raw["entities"] = tuple(EntityRule(**r) for r in raw["entities"])
    if kind is CandidatePack:
        raw |= {k: tuple(raw[k]) for k in ("excluded", "priors")} | {"groups": {k: tuple(v) for k, v in raw["groups"].items()}}
    if kind is RelevancePack:
        raw["tiers"] = tuple(raw["tiers"])
        raw["domains"] = tuple(
            DomainRules(**{**d, **{k: tuple(d[k]) for k in ("required_terms", "required_groups") if k in d}, "proximity": tuple(Proximity(**{**p, "anchors": tuple(p["anchors"]), "evidence": tuple(p["evidence"])}) for p in d.get("proximity", ()))})
            for d in raw["domains"]
        )
    return kind(**raw)


def _signals() -> tuple[SignalRule, ...]:
    phrases = {
        "pain_point": ["takes forever", "went missing", "never loaded", "is a mess"],
        "feature_request": ["i wish there was", "feature request for", "is there a tool"],
        "recommendation_request": ["has anyone used", "looking for an alternative", "need advice"],
        "workaround": ["went back to", "by hand", "i now keep"],
    }
    gated = {"pain_point": ["frustrating", "confusing", "unreliable"], "comparison": ["compared with", "vs", "switched from"]}
    plain = [SignalRule(kind, phrase) for kind, many in phrases.items() for phrase in many]
    return tuple(plain + [SignalRule(kind, phrase, True) for kind, many in gated.items() for phrase in many])


FORUM_ENRICH = EnrichPack(
    "forum_v1",
    _signals(),
    tuple(
        EntityRule(kind, phrase)
        for kind, many in {
            "domain_term": ["visa letter", "work permit", "residence card", "customs receipt", "hostel"],
            "product": ["calendar export", "csv upload", "api token", "offline map", "two-step login"],
            "transport": ["night bus", "ferry pass", "rail voucher", "hostel locker"],
            "payment": ["coupon", "euros", "refund", "coupon worth"],
        }.items()
        for phrase in many
    ),
)

FORUM_CANDIDATES = CandidatePack(
    "forum_broad_v1",
    40,
    ("[deleted]", "[removed]"),
    ("slowvoyages", "tinysaas", "fareclub", "visaqueue"),
    {
        "pain": ("frustrating", "confusing", "takes forever", "went missing", "unreliable"),
        "request": ("i wish there was", "feature request", "looking for", "has anyone used"),
        "workaround": ("by hand", "spreadsheet", "went back to"),
        "tools": ("app", "plan", "api token", "csv upload", "sync", "bot"),
        "travel": ("visa", "passport", "permit", "hostel", "ferry", "train", "customs", "refund"),
        "money": ("coupon", "billing", "price", "refund", "fee"),
    },
)

FORUM_RELEVANCE = RelevancePack(
    "forum_rules_v1",
    (0.8, 0.6, 0.4),
    (
        DomainRules(
            "travel", 0.1, {"travel": 0.35, "pain": 0.15, "request": 0.2, "workaround": 0.15, "money": 0.05}, required_terms=("visa", "passport", "permit", "hostel", "customs"),
            context={"night train": 0.14, "border crossing": 0.3, "residence card": 0.24}, penalties={"coupon worth": 0.35, "lifetime": 0.2},
            proximity=(Proximity("loss", ("hostel", "ferry", "landlord"), ("lost", "went missing", "cancelled"), 12, 0.08),),
        ),
        DomainRules("saas_opportunity", 0.05, {"tools": 0.25, "request": 0.35, "workaround": 0.25, "pain": 0.15, "money": 0.1}, required_groups=("tools",), minimum_groups=2, context={"team plan": 0.2, "api token": 0.15}, penalties={"coupon": 0.4}),
        DomainRules(
            "app_opportunity", 0.05, {"tools": 0.2, "request": 0.35, "pain": 0.15, "workaround": 0.25, "travel": 0.05}, required_groups=("tools",), context={"widget": 0.1, "never loaded": 0.25}, penalties={"promises": 0.15},
            proximity=(Proximity("failure", ("app", "widget", "screen", "bot"), ("crashed", "broke", "never loaded", "stopped"), 12, 0.08),),
        ),
    ),
    {"pain": "pain_point", "request": "feature_request", "workaround": "workaround", "money": "willingness_to_pay"},
)
