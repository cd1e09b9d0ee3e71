"""Prompt texts and response schemas.

The strings below are FIXED VALUES: requests must carry exactly these texts for the
model to see the same instructions, so they are stated verbatim, in their natural
order. Everything that fills them is a Spark Column expression in ``text.py``.
"""

from __future__ import annotations

# ---- FIXED VALUES (do not edit: model-facing texts and schemas) -------------------

ENTITY_TYPES = ["PERSON", "ORGANIZATION", "PRODUCT", "SERVICE", "ISSUE", "LOCATION",
                "CONCEPT", "EVENT"]

EXTRACTION_SYSTEM_INSTRUCTION = (
    "You are an expert at extracting structured knowledge from telecom customer "
    "service call transcripts. Your task is to identify all meaningful entities "
    "and relationships mentioned in the conversation.\n"
    "\n"
    "Entity types to extract: {entity_types}\n"
    "\n"
    "Guidelines:\n"
    "- Extract every distinct entity mentioned, including the customer, agent, "
    "products, services, technical issues, plans, promotions, locations, etc.\n"
    "- Normalize entity names: use UPPERCASE for all entity names.\n"
    "- For each entity, provide a concise but informative description based on "
    "what the transcript says about it.\n"
    "- For each relationship, describe how the two entities are connected in the "
    "context of this transcript.\n"
    "- Assign a weight between 0.0 and 1.0 to each relationship reflecting its "
    "importance in the transcript.\n"
    "- Be thorough: it is better to extract too many entities than too few."
)

EXTRACTION_PROMPT_HEAD = (
    "Extract all entities and relationships from the following telecom customer "
    "service call transcript.\n"
    "\n"
    "---TRANSCRIPT START---\n"
)
EXTRACTION_PROMPT_TAIL = (
    "\n---TRANSCRIPT END---\n"
    "\n"
    'Return the result as JSON with two arrays: "entities" and "relationships".'
)

SUMMARIZATION_SYSTEM_INSTRUCTION = (
    "You are an expert at synthesizing information. Given multiple descriptions "
    "of the same entity or relationship extracted from different sources, merge "
    "them into a single comprehensive description that captures all important "
    "details without redundancy."
)

# entity summary: HEAD_1 + name + HEAD_2 + type + HEAD_3 + numbered lines + TAIL
ENTITY_SUMMARY_PARTS = (
    'The following descriptions all refer to the same entity named "',
    '" (type: ',
    "). Merge them into a single, comprehensive description.\n\nDescriptions:\n",
)
# relationship summary: HEAD_1 + source + HEAD_2 + target + HEAD_3 + numbered lines + TAIL
RELATIONSHIP_SUMMARY_PARTS = (
    'The following descriptions all refer to the same relationship between "',
    '" and "',
    '". Merge them into a single, comprehensive description.\n\nDescriptions:\n',
)
SUMMARY_PROMPT_TAIL = "\n\nProvide a single merged description."

COMMUNITY_REPORT_SYSTEM_INSTRUCTION = (
    "You are an expert analyst producing structured community reports from "
    "knowledge graph data. Each community is a cluster of related entities "
    "and relationships extracted from telecom customer service call transcripts. "
    "Your task is to produce a report that summarizes the community's key themes, "
    "findings, and overall importance."
)

COMMUNITY_REPORT_HEAD = (
    "Write a comprehensive report for the following community of entities and "
    "relationships extracted from telecom customer service call transcripts.\n"
    "\n"
)
COMMUNITY_REPORT_TAIL = (
    "\n"
    "\n"
    "The report should include:\n"
    "- A short, descriptive title\n"
    "- A summary paragraph\n"
    "- An importance rating from 0 to 10 (where 10 is the most important)\n"
    "- An explanation for the rating\n"
    "- A list of key findings, each with a summary and detailed explanation\n"
    "\n"
    "Focus on patterns, recurring issues, and actionable insights."
)

EXTRACTION_RESPONSE_SCHEMA = {
    "type": "OBJECT",
    "properties": {
        "entities": {
            "type": "ARRAY",
            "items": {
                "type": "OBJECT",
                "properties": {
                    "name": {"type": "STRING",
                             "description": "The canonical name of the entity (UPPERCASE)."},
                    "type": {"type": "STRING",
                             "description": "One of: " + ", ".join(ENTITY_TYPES)},
                    "description": {"type": "STRING",
                                    "description": "A concise description of the entity "
                                                   "based on the transcript."},
                },
                "required": ["name", "type", "description"],
            },
        },
        "relationships": {
            "type": "ARRAY",
            "items": {
                "type": "OBJECT",
                "properties": {
                    "source": {"type": "STRING",
                               "description": "The name of the source entity (UPPERCASE)."},
                    "target": {"type": "STRING",
                               "description": "The name of the target entity (UPPERCASE)."},
                    "description": {"type": "STRING",
                                    "description": "A description of the relationship."},
                    "weight": {"type": "NUMBER",
                               "description": "Importance weight from 0.0 to 1.0."},
                },
                "required": ["source", "target", "description", "weight"],
            },
        },
    },
    "required": ["entities", "relationships"],
}

SUMMARIZATION_RESPONSE_SCHEMA = {
    "type": "OBJECT",
    "properties": {
        "description": {"type": "STRING",
                        "description": "The merged, comprehensive description."},
    },
    "required": ["description"],
}

COMMUNITY_REPORT_RESPONSE_SCHEMA = {
    "type": "OBJECT",
    "properties": {
        "title": {"type": "STRING",
                  "description": "A short descriptive title for this community."},
        "summary": {"type": "STRING",
                    "description": "A summary paragraph of the community."},
        "rating": {"type": "NUMBER", "description": "Importance rating from 0 to 10."},
        "rating_explanation": {"type": "STRING",
                               "description": "Explanation for the importance rating."},
        "findings": {
            "type": "ARRAY",
            "items": {
                "type": "OBJECT",
                "properties": {
                    "summary": {"type": "STRING",
                                "description": "Short summary of the finding."},
                    "explanation": {"type": "STRING",
                                    "description": "Detailed explanation of the finding."},
                },
                "required": ["summary", "explanation"],
            },
        },
    },
    "required": ["title", "summary", "rating", "rating_explanation", "findings"],
}

# Context section headers and fallbacks (F16)
SUB_REPORTS_HEADER = "## Sub-Community Reports"
ENTITIES_HEADER = "## Entities"
RELATIONSHIPS_HEADER = "## Relationships"
UNTITLED = "Untitled"
NOT_AVAILABLE = "N/A"

# ---- end of fixed values -----------------------------------------------------------


def extraction_system_instruction() -> str:
    return EXTRACTION_SYSTEM_INSTRUCTION.replace("{entity_types}", ", ".join(ENTITY_TYPES))
