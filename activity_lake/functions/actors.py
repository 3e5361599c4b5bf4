"""Bot flag and actor class of a login.

A login with the platform's ``[bot]`` suffix is a bot; its class comes from the lists
below, or is ``other_bot``. Any other login is ``human``. The lookup is a literal set
a class in generated code: no join, no broadcast, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOT_SUFFIX = "[bot]"

HUMAN = "human"
AI_AGENT = "ai_agent"
DEPENDENCY_BOT = "dependency_bot"
CI_BOT = "ci_bot"
OTHER_BOT = "other_bot"
ACTOR_CLASSES = (HUMAN, AI_AGENT, DEPENDENCY_BOT, CI_BOT, OTHER_BOT)

# --- fixed values: login lists that must equal the reference's (compared
# against the login with its "[bot]" suffix removed) -------------------------
AI_AGENT_LOGINS = (
    "cursor",
    "devin-ai-integration",
    "chatgpt-codex-connector",
    "claude",
    "coderabbitai",
    "arena-ai-coding-agent",
    "copilot",
    "copilot-swe-agent",
    "sweep-ai",
    "codium-ai",
    "ellipsis-dev",
    "graphite-app",
    "gemini-code-assist",
    "amazon-q-developer",
    "lovable-dev",
    "qodo-merge-pro",
    "cubic-dev-ai",
)
DEPENDENCY_BOT_LOGINS = (
    "dependabot",
    "dependabot-preview",
    "renovate",
    "renovate-bot",
    "pyup-bot",
    "greenkeeper",
    "snyk-bot",
)
CI_BOT_LOGINS = (
    "github-actions",
    "github-merge-queue",
    "vercel",
    "netlify",
    "circleci",
    "travis-ci",
    "codecov",
    "sonarcloud",
    "trunk-io",
    "copybara-service",
    "codelinaro-mirror-sync",
    "pull",
    "imgbot",
    "allcontributors",
    "swa-runner-app",
    "swa-synthetics",
    "sonarqubecloud",
    "mergify",
    "kodiakhq",
    "openshift-ci",
    "amazon-codecatalyst",
    "codecatalyst-integ",
    "aws-connector-for-github",
    "cloudflare-workers-and-pages",
    "trunk-staging-io",
    "azure-pipelines",
)
# --- end of fixed values ----------------------------------------------------


LOGINS_BY_CLASS = {AI_AGENT: AI_AGENT_LOGINS, DEPENDENCY_BOT: DEPENDENCY_BOT_LOGINS, CI_BOT: CI_BOT_LOGINS}


def class_lookup() -> dict[str, str]:
    """``{base login: class}``; a login on two lists keeps the later list."""
    return {login: cls for cls, logins in LOGINS_BY_CLASS.items() for login in logins}


def is_bot(login: Column) -> Column:
    """Three-valued: NULL login gives NULL (kept, as the quality gate reports it)."""
    return login.endswith(BOT_SUFFIX)


def base_login(login: Column) -> Column:
    return F.regexp_replace(login, r"\[bot\]$", "")


def classify_actor(login: Column, lookup: dict[str, str] | None = None) -> Column:
    """human / ai_agent / dependency_bot / ci_bot / other_bot.

    A NULL login is not provably human, so it falls to ``other_bot`` (its bot
    flag stays NULL); the gate forbids NULL actors anyway.
    """
    lookup = class_lookup() if lookup is None else lookup
    bot = is_bot(login)
    out = F.when(bot.isNotNull() & ~bot, F.lit(HUMAN))
    # The listed logins with their suffix: hash sets, looked up only for suffixed (or NULL) logins.
    for cls in sorted(set(lookup.values())):
        out = out.when(login.isin([k + BOT_SUFFIX for k in sorted(lookup) if lookup[k] == cls]), F.lit(cls))
    return out.otherwise(F.lit(OTHER_BOT))


def max_class(cls: Column) -> Column:
    """Aggregate ``max(actor_class)``, also of classes outside the vocabulary (so that the
    accepted-values check can see them)."""
    return F.max(cls)
