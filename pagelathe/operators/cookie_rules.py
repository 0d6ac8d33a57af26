"""Which elements are consent containers.

The selectors are fixed values: element ids, classes and attributes that the
named consent managers write. Each is a compound of tag, id, class and
attribute tests without combinators.
"""

from __future__ import annotations

import re
from html import unescape

from .html_tree import Node

#: Provider -> selectors of its outermost container.
COOKIE_SELECTORS: dict[str, str] = {
    "CookieBot": "#CybotCookiebotDialog #CybotCookiebotDialogBodyUnderlay #CybotCookiebotFader #Cookiebot"
    " #CookiebotWidget #CookieConsentStateDisplayStyles #CookiebotDialogStyle #CookieBanner .CookieDeclaration",
    "CookieYes": "#cookieyes #cookieyes-banner [class*='cky-consent'] [class*='cky-cookie'] [class*='wcc-cookie']"
    " [role='dialog'].wcc-modal .cky-modal [class*='cky-accordion']",
    "CookieScript": "#cookiescript_injected_wrapper",
    "Complianz": "#cmplz-cookiebanner-container #cmplz-manage-consent [class*='cmplz-consent']"
    " [class*='cookie-statement']",
    "OneTrust": "#onetrust-consent-sdk #onetrust-banner-sdk .onetrust-pc-dark-filter",
    "MooveGDPR": "#moove_gdpr_cookie_info_bar #moove_gdpr_cookie_modal [id^='moove_gdpr'] [id^='moove-gdpr']",
    "COI": "[class*='coi-consent-banner'] [class*='cookie-details']",
    "Cassie": "#cassie-widget #cassieLoaderId",
    "AirCookie": "[data-aircookie-remove-on]",
    "CookieFirst": "[data-cookiefirst-widget]",
    "CookieLawInfo": "#cookie-law-info-bar #cookie-law-info-again [class*='cookielawinfo'] [class*='wt-cli-cookie']",
    "PrestoGDPR": "[class*='pr-cookie']",
    "HubSpot": "#hs-eu-cookie-confirmation",
    "CookieInformation": "#cookie-information-template-wrapper",
    "Borlabs": "#BorlabsCookieBox",
    "CookieHub": ".ch2",
    "Teamtailor": "dialog.company-links dialog.text-company-primary"
    " dialog[data-controller='common--cookies--alert'] dialog[data-controller='common--cookies--preferences']",
    "CookieConsent": "#cliSettingsPopup [role='dialog'].cc-window [role='dialog']#cm [role='dialog']#s-cnt"
    " dialog.cookie-popup",
    "Termly": "#termly-code-snippet-support",
    "SimpleBanner": ".simple-banner",
    "Generic": "[data-cookieconsent] #hu-cookies #cookieDiv #cookie-container #cookie-notice #cookiebar #consentUI"
    " #dsh-cookie-modal #fyfconsent [id^='pd-cp-cookie'] .tru_cookie-dialog_wrapper .cookieadmin_cookie_modal"
    " .consent-banner-root .cookies .ez-consent .outershell .outershellRiverty",
}
#: Parts of the id of a script, style or link of a consent manager.
COOKIE_SCRIPT_IDS = (
    "cookie consent gdpr cmplz moove_gdpr cookielaw pll_cookie wpml-cookie wc-js-cookie".split()
)

_PART = re.compile(r"^([a-z]+)|#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*^]?)='([^']*)')?\]")


def _compile(selector: str) -> tuple:
    """(tag, tests) with tests as (attribute, operator, value)."""
    tag, tests = None, []
    for m in _PART.finditer(selector):
        if m[1]:
            tag = m[1]
        elif m[2]:
            tests.append(("id", "=", m[2]))
        elif m[3]:
            tests.append(("class", "~", m[3]))
        else:
            tests.append((m[4], (m[5] or "=") if m[6] is not None else "?", m[6]))
    return tag, tuple(tests)


RULES = [(provider, s, *_compile(s)) for provider, group in COOKIE_SELECTORS.items() for s in group.split()]
_BY_ID = {t[0][2]: i for i, (_, _, tag, t) in enumerate(RULES) if tag is None and len(t) == 1 and t[0][:2] == ("id", "=")}
_BY_CLASS = {
    t[0][2]: i for i, (_, _, tag, t) in enumerate(RULES) if tag is None and len(t) == 1 and t[0][:2] == ("class", "~")
}
_OTHERS = [i for i in range(len(RULES)) if i not in {*_BY_ID.values(), *_BY_CLASS.values()}]


#: Every rule needs one of these parts: the cheap test before the tree is searched.
_HINTS = (
    "cookie consent gdpr cky- wcc- cmplz onetrust moove cassie dialog ch2 clisettings simple-banner outershell termly"
    .split()
)
#: The same in names and values of attributes, whose letters count as they are.
_SIGNS = re.compile("|".join(map(re.escape, _HINTS)), re.I)


def _holds(node: Node, test: tuple) -> bool:
    name, op, value = test
    if not node.attrs or name not in node.attrs:
        return False
    own = node.attrs[name]
    if op == "?":
        return True
    if op == "~":
        return value in own.split()
    if name == "class":
        own = " ".join(own.split())
    return own == value if op == "=" else own.startswith(value) if op == "^" else value in own


def matching_rules(node: Node) -> list[int]:
    """Numbers of the rules that match an element, in the order of the rules."""
    attrs = node.attrs
    if not attrs or len(attrs) == 1 and "href" in attrs:
        return []
    found = []
    if (own := attrs.get("id")) in _BY_ID:
        found.append(_BY_ID[own])
    if "class" in attrs:
        found += [_BY_CLASS[c] for c in set(attrs["class"].split()) if c in _BY_CLASS]
    if node.name != "dialog" and not _SIGNS.search(" ".join([f"{k} {v}" for k, v in attrs.items()])):
        return sorted(found)
    for i in _OTHERS:
        _, _, tag, tests = RULES[i]
        if (tag is None or tag == node.name) and all(_holds(node, t) for t in tests):
            found.append(i)
    return sorted(found)


def may_match(html: str) -> bool:
    """Whether some rule might match; letters of attributes may be written as numbers."""
    low = (unescape(html) if "&#" in html else html).lower()
    return any(h in low for h in _HINTS)


def find_containers(root: Node) -> list[Node]:
    """Outermost consent containers, in the order of the rules that match them.

    Script, style and link elements with a telling id are taken out at once.
    """
    hits: dict[int, tuple[int, int, Node]] = {}
    scripts = []
    for at, node in enumerate(root.elements()):
        if not node.attrs:
            continue
        if rules := matching_rules(node):
            hits[id(node)] = (rules[0], at, node)
        elif node.name in ("script", "style", "link"):
            own = node.attrs.get("id", "").lower()
            if own and any(p in own for p in COOKIE_SCRIPT_IDS):
                scripts.append(node)
    for node in scripts:
        node.parent.children.remove(node)
    out = []
    for _, _, node in sorted(hits.values(), key=lambda x: x[:2]):
        up = node.parent
        while up is not None and id(up) not in hits:
            up = up.parent
        if up is None:
            out.append(node)
    return out


def removals(root: Node) -> list[dict]:
    """What a clean-up takes out: one entry per element, in the order of the rules."""
    found = []
    for at, node in enumerate(root.elements()):
        rules = matching_rules(node)
        if rules:
            found.append((rules[0], at, node, RULES[rules[0]][0], RULES[rules[0]][1]))
        elif node.name in ("script", "style", "link"):
            own = node.get("id")
            if own and any(p in own.lower() for p in COOKIE_SCRIPT_IDS):
                found.append((len(RULES), at, node, "ScriptCleanup", f"#{own}"))
    return [
        {"provider": p, "selector": s, "tag": n.name, "id": n.attrs.get("id"), "classes": n.classes()}
        for _, _, n, p, s in sorted(found, key=lambda x: x[:2])
    ]
