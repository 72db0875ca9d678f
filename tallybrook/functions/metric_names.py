"""Turning bean attribute names into metric names and labels, by a rule list."""

from dataclasses import dataclass, field

from pyspark.sql import functions as F


# Above this many distinct names the translated names are not broadcast.
MAX_NAMES = 50_000


@dataclass(frozen=True)
class Rule:
    pattern: str
    name: str
    kind: str
    labels: dict = field(default_factory=dict)


# The rule list. Order matters, the first rule that matches wins.
RULES = (
    Rule(
        r"kafka.server<type=(.+), name=(.+), clientId=(.+), topic=(.+), partition=(.*)><>Value",
        "kafka_server_$1_$2",
        "GAUGE",
        {"clientId": "$3", "topic": "$4", "partition": "$5"},
    ),
    Rule(
        r"kafka.server<type=(.+), name=(.+), clientId=(.+), brokerHost=(.+), brokerPort=(.+)><>Value",
        "kafka_server_$1_$2",
        "GAUGE",
        {"clientId": "$3", "broker": "$4:$5"},
    ),
    Rule(
        r"kafka.coordinator.(\w+)<type=(.+), name=(.+)><>Value",
        "kafka_coordinator_$1_$2_$3",
        "GAUGE",
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*, (.+)=(.+), (.+)=(.+)><>Count",
        "kafka_$1_$2_$3_total",
        "COUNTER",
        {"$4": "$5", "$6": "$7"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*, (.+)=(.+)><>Count",
        "kafka_$1_$2_$3_total",
        "COUNTER",
        {"$4": "$5"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*><>Count",
        "kafka_$1_$2_$3_total",
        "COUNTER",
    ),
    Rule(
        r"kafka.server<type=(.+), user=(.+), client-id=(.+)><>([a-z-]+)",
        "kafka_server_quota_$4",
        "GAUGE",
        {"resource": "$1", "user": "$2", "clientId": "$3"},
    ),
    Rule(
        r"kafka.server<type=(.+), client-id=(.+)><>([a-z-]+)",
        "kafka_server_quota_$3",
        "GAUGE",
        {"resource": "$1", "clientId": "$2"},
    ),
    Rule(
        r"kafka.server<type=(.+), user=(.+)><>([a-z-]+)",
        "kafka_server_quota_$3",
        "GAUGE",
        {"resource": "$1", "user": "$2"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+), (.+)=(.+)><>Value",
        "kafka_$1_$2_$3",
        "GAUGE",
        {"$4": "$5", "$6": "$7"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+)><>Value",
        "kafka_$1_$2_$3",
        "GAUGE",
        {"$4": "$5"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)><>Value",
        "kafka_$1_$2_$3",
        "GAUGE",
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+), (.+)=(.+)><>Count",
        "kafka_$1_$2_$3_count",
        "COUNTER",
        {"$4": "$5", "$6": "$7"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.*), (.+)=(.+)><>(\d+)thPercentile",
        "kafka_$1_$2_$3",
        "GAUGE",
        {"$4": "$5", "$6": "$7", "quantile": "0.$8"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+)><>Count",
        "kafka_$1_$2_$3_count",
        "COUNTER",
        {"$4": "$5"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.*)><>(\d+)thPercentile",
        "kafka_$1_$2_$3",
        "GAUGE",
        {"$4": "$5", "quantile": "0.$6"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)><>Count",
        "kafka_$1_$2_$3_count",
        "COUNTER",
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)><>(\d+)thPercentile",
        "kafka_$1_$2_$3",
        "GAUGE",
        {"quantile": "0.$4"},
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)Percent\w*><>MeanRate",
        "kafka_$1_$2_$3_percent",
        "GAUGE",
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)Percent\w*><>Value",
        "kafka_$1_$2_$3_percent",
        "GAUGE",
    ),
    Rule(
        r"kafka.(\w+)<type=(.+), name=(.+)Percent\w*, (.+)=(.+)><>Value",
        "kafka_$1_$2_$3_percent",
        "GAUGE",
        {"$4": "$5"},
    ),
)


SLOTS = max(len(r.labels) for r in RULES)
# Between the parts of a filled template; no attribute name contains it.
SEPARATOR = "\x01"


def _safe(name):
    """Letters, digits, `:` and `_` only, runs of `_` merged."""
    return F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9:_]", "_"), "_+", "_")


def _attribute_test(pattern, attribute):
    """A cheap test on the text after `><>` that any match must pass."""
    tail = pattern.split("><>")[1]
    if tail.isalpha():
        return attribute.contains(f"><>{tail}")
    if tail.endswith("thPercentile"):
        return attribute.contains("thPercentile")
    return attribute.contains("><>")


def _by_rule(values):
    """The entry of `values` (one per rule) for the row's rule."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_rule"))


def _template(rule):
    """Name and label templates of a rule as one replacement text."""
    labels = list(rule.labels.items()) + [("", "")] * (SLOTS - len(rule.labels))
    return SEPARATOR.join([rule.name, *[part for label in labels for part in label]])


def _translate(df, column, rules, when=None):
    attribute = F.col(column)
    matches = [_attribute_test(r.pattern, attribute) & attribute.rlike(r.pattern) for r in rules]
    number = F.coalesce(*[F.when(m, F.lit(i)) for i, m in enumerate(matches, start=1)])
    if when is not None:
        number = F.when(when, number)
    # one replacement fills the name and all labels
    whole = _by_rule([f"^.*?(?:{r.pattern}).*$" for r in rules])
    filled = F.regexp_replace(attribute, whole, _by_rule([_template(r) for r in rules]))
    parts = (
        df.withColumn("_rule", number)
        .filter(F.col("_rule").isNotNull())
        .withColumn("_parts", F.split(filled, SEPARATOR))
    )
    slots = range(SLOTS)
    return (
        parts.withColumns({f"_k{n}": _safe(F.col("_parts")[2 * n + 1]) for n in slots})
        .withColumn("_pairs", F.array(*[_label(n) for n in slots]))
        .select(
            *df.columns,
            F.lower(_safe(F.col("_parts")[0])).alias("metric"),
            _by_rule([r.kind for r in rules]).alias("kind"),
            F.map_from_entries(F.array_compact("_pairs")).alias("labels"),
        )
    )


def _label(n):
    """Label pair n, or null where it is empty or repeats an earlier label."""
    name, value = F.col(f"_k{n}"), F.col("_parts")[2 * n + 2]
    usable = (name != "") & (value != "")
    for earlier in range(n):
        usable = usable & (F.col(f"_k{earlier}") != name)
    return F.when(usable, F.struct(name.alias("key"), value.alias("value")))


def normalise_metric_names(df, column="attribute", rules=RULES, max_names=MAX_NAMES):
    """Add `metric`, `kind` and `labels`; drop rows that no rule matches.

    Attribute names are few and repeat with every scrape, while a row may have to
    try every pattern: up to `max_names` distinct names are translated once and
    joined back by broadcast. Beyond that every row is translated where it is.
    """
    names = df.groupBy(column).agg(F.count(F.lit(1)).alias("_uses"))
    if names.limit(max_names + 1).count() > max_names:
        return _translate(df, column, rules)
    # tying the rule to an aggregate keeps the patterns from being tried on single
    # rows: a test of the name alone would be pushed below the grouping
    translated = _translate(names, column, rules, when=F.col("_uses") > 0).drop("_uses")
    return df.join(F.broadcast(translated), column)
