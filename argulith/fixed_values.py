"""Names, templates and sentences that results must contain letter by letter."""

# Raw label name -> canonical label.
LABEL_ALIASES = {
    "intentional": "intentional",
    "fallacy of credibility": "fallacy_of_credibility",
    "false dilemma": "false_dilemma",
    "equivocation": "equivocation",
    "faulty generalization": "faulty_generalization",
    "ad populum": "appeal_to_popularity",
    "ad hominem": "ad_hominem",
    "false causality": "false_cause",
    "fallacy of logic": "logical_fallacy",
    "fallacy of relevance": "relevance_fallacy",
    "appeal to emotion": "appeal_to_emotion",
    "fallacy of extension": "straw_man",
    "circular reasoning": "circular_reasoning",
    "appeal to popularity": "appeal_to_popularity",
    "false cause": "false_cause",
    "hasty generalization": "faulty_generalization",
    "logical fallacy": "logical_fallacy",
    "relevance fallacy": "relevance_fallacy",
    "straw man": "straw_man",
}

CANONICAL_LABELS = sorted(set(LABEL_ALIASES.values()))

# Entity types that are masked, with their placeholders.
ENTITY_PLACEHOLDERS = {
    "PERSON": "[PERSON]",
    "ORG": "[ORG]",
    "GPE": "[GPE]",
    "LOC": "[LOC]",
    "NORP": "[NORP]",
    "DATE": "[DATE]",
    "TIME": "[TIME]",
    "MONEY": "[MONEY]",
    "PERCENT": "[PERCENT]",
    "EVENT": "[EVENT]",
}

# Label -> (explanation template, example sentence).
EXPLANATIONS = {
    "ad_hominem": (
        "This argument commits the AD HOMINEM fallacy. Instead of addressing the argument about {topic}, it attacks the character of {person}, which is logically irrelevant to whether the claim is true.",
        "Example: 'You can't trust Dr. Smith's research because he drives an SUV' attacks the person, not the research.",
    ),
    "appeal_to_emotion": (
        "This argument commits the APPEAL TO EMOTION fallacy. It uses {emotion} to manipulate the audience instead of providing logical evidence for {claim}.",
        "Example: 'Think of the starving children!' evokes pity instead of providing evidence.",
    ),
    "appeal_to_popularity": (
        "This argument commits the APPEAL TO POPULARITY fallacy. It assumes that because {many_people} believe or do {thing}, it must be true or correct.",
        "Example: 'Everyone is buying this product, so it must be the best' uses popularity as evidence.",
    ),
    "circular_reasoning": (
        "This argument commits CIRCULAR REASONING. It uses {claim} as both a premise and the conclusion, creating a logical loop without external evidence.",
        "Example: 'The Bible is true because it says so in the Bible' proves nothing.",
    ),
    "equivocation": (
        "This argument commits EQUIVOCATION. It uses the term '{term}' in two different senses, leading to a misleading conclusion.",
        "Example: 'A feather is light, so it can't be heavy' uses 'light' in two different ways.",
    ),
    "fallacy_of_credibility": (
        "This argument commits the FALLACY OF CREDIBILITY (Appeal to False Authority). It relies on {source} who is not a reliable expert on {topic}.",
        "Example: 'My actor friend says this medicine works' - actors aren't medical experts.",
    ),
    "false_cause": (
        "This argument commits the FALSE CAUSE fallacy (Post Hoc Ergo Propter Hoc). It assumes that because {event_a} happened before {event_b}, {event_a} caused {event_b}.",
        "Example: 'I wore my lucky socks and we won, so the socks caused the win' confuses correlation with causation.",
    ),
    "false_dilemma": (
        "This argument commits the FALSE DILEMMA fallacy. It presents only {option_a} and {option_b} as options, ignoring other valid possibilities.",
        "Example: 'You're either with us or against us' ignores neutral positions.",
    ),
    "faulty_generalization": (
        "This argument commits the FAULTY GENERALIZATION (Hasty Generalization) fallacy. It draws a conclusion about all {group} based on only {count} example(s).",
        "Example: 'I met two rude New Yorkers, so everyone there is rude' - insufficient sample size.",
    ),
    "intentional": (
        "This argument appears INTENTIONALLY MISLEADING. The reasoning is deliberately structured to deceive rather than inform.",
        "Example: Cherry-picking data to support a predetermined conclusion.",
    ),
    "logical_fallacy": (
        "This argument contains a LOGICAL FALLACY. The conclusion does not logically follow from the premises provided.",
        "Example: 'If A then B, B is true, therefore A is true' - affirming the consequent.",
    ),
    "relevance_fallacy": (
        "This argument commits a RELEVANCE FALLACY (Red Herring). It introduces irrelevant information about {distraction} to divert attention from the main issue.",
        "Example: 'Why worry about pollution when people are starving?' - changes the subject.",
    ),
    "straw_man": (
        "This argument commits the STRAW MAN fallacy. It misrepresents the original position on {topic} as {misrepresentation}, then attacks this distorted version.",
        "Example: 'You want to lower military spending? So you want us defenseless!' - exaggerates the position.",
    ),
}

# Fixed value: label whose template stands in for unknown labels.
FALLBACK_LABEL = "logical_fallacy"

# Words that announce a topic.
TOPIC_MARKERS = ["about", "regarding", "concerning", "on"]

# What a slot holds when the text does not fill it.
DEFAULT_TOPIC = "the issue"
DEFAULT_PERSON = "the speaker"
CONSTANT_SLOTS = {
    "emotion": "fear or pity",
    "many_people": "many people",
    "thing": "something",
    "event_a": "one event",
    "event_b": "another event",
    "option_a": "one option",
    "option_b": "another option",
    "group": "the group",
    "count": "a few",
    "term": "a key term",
    "source": "an unqualified source",
    "distraction": "something irrelevant",
    "misrepresentation": "an exaggerated version",
}

# Confidence above the bound -> text; the last one is for all the rest.
CONFIDENCE_TEXTS = [
    (0.9, " (Very high confidence)"),
    (0.7, " (High confidence)"),
    (0.5, " (Moderate confidence)"),
]
LOW_CONFIDENCE_TEXT = " (Low confidence)"

# Label -> contrastive template.
CONTRASTS = {
    "ad_hominem": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. Instead of addressing the logical content about {topic}, it attacks the character or personal attributes of {person}, which is irrelevant to whether the claim is true.",
    "appeal_to_popularity": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It assumes that because {many_people} believe or do something, it must be true or correct, whereas a sound argument would provide actual evidence.",
    "false_cause": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It assumes that {event_a} caused {event_b} solely because they occurred together, without demonstrating a causal mechanism.",
    "false_dilemma": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It presents only {option_a} and {option_b} as options, ignoring the full spectrum of alternatives that exist.",
    "faulty_generalization": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It draws a conclusion about all {group} based on only {count} example(s), which is insufficient evidence.",
    "equivocation": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It uses the term '{term}' in two different senses, leading to a misleading conclusion.",
    "straw_man": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It misrepresents the original position on {topic} by exaggerating or distorting it, then attacks this distorted version.",
    "appeal_to_emotion": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It uses emotional manipulation about {emotion_topic} instead of providing logical evidence.",
    "circular_reasoning": "This argument commits the {fallacy} fallacy rather than a {alt_fallacy} fallacy. It uses the conclusion about {claim} as one of its own premises.",
}
CONTRAST_DEFAULT = "This argument contains a logical fallacy. Unlike {alt_fallacy} which would have valid reasoning, the logic here is flawed because {reason}."

# Slots of the contrastive templates that no text fills.
CONTRAST_CONSTANTS = {
    "many_people": "many people",
    "count": "1",
    "reason": "the premises do not support the conclusion",
}
CONTRAST_NO_ALTERNATIVE = "fallacies that rely on evidence"
CONTRAST_FALLBACKS = {
    "person": "the person",
    "topic": "the issue",
    "event_a": "one event",
    "event_b": "another event",
    "option_a": "one option",
    "option_b": "another option",
    "group": "the group",
    "term": "a term",
    "emotion_topic": "emotions",
    "claim": "the claim",
}

# Label -> short description, used for the alternative.
ALTERNATIVE_DESCRIPTIONS = {
    "ad_hominem": "a fallacy that attacks the person",
    "appeal_to_popularity": "a fallacy based on popularity",
    "false_cause": "a false causal claim",
    "false_dilemma": "an oversimplified either-or argument",
    "faulty_generalization": "a hasty generalization",
    "equivocation": "an ambiguous term fallacy",
    "straw_man": "a misrepresentation fallacy",
    "circular_reasoning": "circular logic",
    "appeal_to_emotion": "an emotional appeal",
}
ALTERNATIVE_DESCRIPTION_DEFAULT = "a logical fallacy based on evidence"

# Label -> one-sentence explanation.
STANDARD_EXPLANATIONS = {
    "ad_hominem": "This argument attacks the person making the claim rather than addressing the claim itself.",
    "appeal_to_popularity": "This argument relies on popularity rather than evidence to support its conclusion.",
    "false_cause": "This argument assumes correlation implies causation without sufficient evidence.",
    "false_dilemma": "This argument presents only two options when more possibilities exist.",
    "faulty_generalization": "This argument draws a broad conclusion from insufficient evidence.",
    "equivocation": "This argument uses an ambiguous term in different ways.",
    "straw_man": "This argument misrepresents the opponent's position to make it easier to attack.",
    "appeal_to_emotion": "This argument uses emotional manipulation instead of logical reasoning.",
    "circular_reasoning": "This argument uses its conclusion as one of its premises.",
}
STANDARD_EXPLANATION_DEFAULT = "This argument contains a logical fallacy."

# Names of the two explanation sources.
RETRIEVAL_SOURCE = "RAG"
CONTRAST_SOURCE = "CPACE"

# Text put before a passage or a query when it is encoded.
PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "
