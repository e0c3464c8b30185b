"""Features of raw HTML pages: text counts, start tags as an array of structs, and calls in inline scripts.

Markup is read by regular expressions, not repaired: no html or body tag is added, and what a tag-soup parser would move
or close stays as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from netsift.functions import text as t

TAG = r"(?s)<([A-Za-z][A-Za-z0-9:-]*)((?:\\s+|/)(?:[^<>\"'']|\"[^\"]*\"|''[^'']*'')*)?>".replace("''", "\\'")
# What the script columns count.
SCRIPT_CALLS = {
    "create_element": r"createElement\\(", "write": r"write\\(", "char_code_at": r"charCodeAt\\(", "concat": r"concat\\(",
    "escape": r"(?<!n)escape\\(", "eval": r"eval\\(", "exec": r"exec\\(", "from_char_code": r"fromCharCode\\(", "link": r"link\\(",
    "parse_int": r"parseInt\\(", "replace": r"replace\\(", "search": r"search\\(", "substring": r"substring\\(", "unescape": r"unescape\\(",
    "add_event_listener": r"addEventListener\\(", "set_interval": r"setInterval\\(", "set_timeout": r"setTimeout\\(", "push": r"push\\(",
    "index_of": r"indexOf\\(", "document_write": r"document[.]write\\(", "get": r"get\\(", "find": r"find\\(",
    "document_create_element": r"document[.]createElement\\(", "window_set_timeout": r"window[.]setTimeout\\(",
    "window_set_interval": r"window[.]setInterval\\(", "hex_encoding": r"\\\\x[0-9A-Fa-f]{2}", "unicode_encoding": r"\\\\u[0-9A-Fa-f]{4}",
    "long_variable_name": r"\\b[a-zA-Z0-9_]{20,}\\b",
}
BLOCKED = r"(?i)\\b(suspended|blocked|forbidden|denied|restricted)\\b"
HIDING = ("display: none", "visibility: hidden", "opacity: 0", "position: absolute")


def attribute(attrs: str, name: str) -> str:
    """SQL: an attribute's value, empty if it has none; null if the attribute isn't there."""
    found = f"regexp_extract({attrs}, '(?is)(?:^|[\\\\s/\"\\'])(?:{name})\\\\s*=\\\\s*(\"[^\"]*\"|\\'[^\\']*\\'|[^\\\\s\"\\'>]+)', 1)"
    there = f"{attrs} rlike '(?is)(?:^|[\\\\s/\"\\'])({name})(?:\\\\s*=|[\\\\s/]|$)'"
    value = t.let(found, "_v", f"if(_v <> '', regexp_replace(_v, '^[\"\\']|[\"\\']$', ''), if({there}, '', null))")
    return f"if({attrs} = '', null, {value})"


def text_columns(html: str) -> dict[str, str]:
    words = f"filter(split({html}, '\\\\s+'), x -> x <> '')"
    return {
        "html_num_of_words": f"size({words})",
        "html_num_of_lines": f"if({html} = '', 0, regexp_count({html}, '\\\\r\\\\n|[\\\\n\\\\r\\\\x0B\\\\f]') + if({html} rlike '[\\\\n\\\\r\\\\x0B\\\\f]$', 0, 1))",
        "html_unique_words": f"size(array_distinct({words}))",
        "html_average_word_len": t.ratio(f"length(regexp_replace({html}, '\\\\s', ''))", f"size({words})"),
        "html_blocked_keywords_label": f"cast({html} rlike '{BLOCKED}' as int)",
        "html_num_of_blank_spaces": f"regexp_count({html}, '\\\\s{{2,}}')",
    }


def with_tags(df: DataFrame) -> DataFrame:
    """df with _tags: array of (name, and the attributes that features look at), and _scripts: inline script elements."""
    clean = "regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '')"
    body = f"regexp_replace({clean}, '(?is)(<(script|style)\\\\b[^>]*>).*?</\\\\2\\\\s*>', '$1')"
    df = df.selectExpr("*", f"regexp_extract_all({body}, '{TAG}', 0) as _raw", f"regexp_extract_all({clean}, '(?is)<script\\\\b[^>]*>.*?</script\\\\s*>', 0) as _all_scripts")
    names = ("href", "src", "action", "style", "type", "async", "hidden")
    fields = ", ".join(f"'{n}', {attribute('p.a', n)}" for n in names)
    split = "transform(_raw, x -> named_struct('name', lower(regexp_extract(x, '^<([A-Za-z][A-Za-z0-9:-]*)', 1)), 'a', regexp_replace(x, '^<[A-Za-z][A-Za-z0-9:-]*|>$', '')))"
    df = df.selectExpr("*", f"{split} as _parts").selectExpr("*", f"transform(_parts, p -> named_struct('name', p.name, {fields})) as _tags")
    inline = f"array_join(filter(_all_scripts, x -> {attribute('''regexp_extract(x, '(?is)^<script([^>]*)>', 1)''', 'src')} is null), '')"
    return df.selectExpr("*", f"{inline} as _js").drop("_raw", "_parts", "_all_scripts")


def _count(cond: str) -> str:
    return f"size(filter(_tags, x -> {cond}))"


def tag_columns() -> dict[str, str]:
    hiding = " or ".join(f"contains(coalesce(x.style, ''), '{h}')" for h in HIDING)
    hrefs = "transform(filter(_tags, x -> x.name = 'a' and x.href <> ''), x -> x.href)"
    outer, n = f"size(filter({hrefs}, h -> contains(h, 'http')))", f"size({hrefs})"
    inner = f"size(filter({hrefs}, h -> not contains(h, 'http')))"
    form = lambda part: _count(f"x.name = 'form' and contains(x.action, '{part}')")
    named = lambda name: _count(f"x.name = '{name}'")
    has = lambda name, attr: _count(f"x.name = '{name}' and x.{attr} is not null")
    zero = "0"  # the definition looks for an attribute of this odd name, which no element has
    return {
        "html_num_of_tags": "size(array_distinct(transform(_tags, x -> x.name)))", "html_num_of_paragraphs": named("p"), "html_num_of_divs": named("div"), "html_num_of_titles": named("title"),
        "html_num_of_external_js": has("script", "src"), "html_num_of_links": named("link"), "html_num_of_scripts": named("script"), "html_num_of_scripts_async": has("script", "async"),
        "html_num_of_scripts_type": has("script", "type"), "html_num_of_anchors": named("a"), "html_num_of_anchors_to_hash": zero,
        "html_num_of_anchors_to_https": _count("x.name = 'a' and contains(x.href, 'http')"), "html_num_of_anchors_to_com": _count("x.name = 'a' and contains(x.href, '.com')"),
        "html_num_of_inputs": named("input"), "html_num_of_input_password": zero, "html_num_of_hidden_elements": _count(f"x.hidden is not null or {hiding}"),
        "html_num_of_input_hidden": _count(f"x.name = 'input' and (x.type <=> 'hidden' or {hiding})"), "html_num_of_objects": named("object"), "html_num_of_embeds": named("embed"),
        "html_num_of_frame": named("frame"), "html_num_of_iframe": named("iframe"), "html_num_of_iframe_src": has("iframe", "src"),
        "html_num_of_iframe_src_https": _count("x.name = 'iframe' and contains(x.src, 'http')"), "html_num_of_center": named("center"), "html_num_of_imgs": named("img"),
        "html_num_of_imgs_src": has("img", "src"), "html_num_of_meta": named("meta"), "html_num_of_links_href": has("link", "href"),
        "html_num_of_links_href_https": _count("x.name = 'link' and contains(x.href, 'http')"), "html_num_of_links_href_css": _count("x.name = 'link' and contains(x.href, '.css')"),
        "html_num_of_links_type": has("link", "type"), "html_num_of_link_type_app": zero, "html_num_of_link_rel": zero, "html_num_of_all_hrefs": _count("x.href is not null"),
        "html_num_of_form_action": has("form", "action"), "html_num_of_form_http": form("http"), "html_num_of_strong": named("strong"), "html_no_hrefs": f"cast({n} = 0 as int)",
        "html_internal_href_ratio": f"cast({n} > 0 and {inner} / {n} <= 0.5 as int)", "html_num_of_internal_hrefs": inner,
        "html_external_href_ratio": f"cast({n} > 0 and {outer} / {n} > 0.5 as int)", "html_num_of_external_href": outer, "html_num_of_icon": zero, "html_icon_external": zero,
        "html_num_of_form_php": form(".php"), "html_num_of_form_hash": form("#"),
        "html_num_of_form_js": _count("x.name = 'form' and (contains(x.action, 'javascript:void()') or contains(x.action, 'javascript:void(0)'))"),
        "html_malicious_form": f"cast({_count('''x.name = 'form' and (contains(x.action, 'http') or contains(x.action, '.php') or contains(x.action, '#') or contains(x.action, 'javascript:void'))''')} > 0 as int)",
        "html_most_common": t.mode_share(hrefs), "html_num_of_css_internal": zero, "html_num_of_css_external": zero, "html_num_of_anchors_to_content": zero, "html_num_of_anchors_to_void": zero,
    }


def script_columns() -> dict[str, str]:
    return {f"html_{k}": f"regexp_count(_js, '{p}')" for k, p in SCRIPT_CALLS.items()}


def html_features(df: DataFrame) -> DataFrame:
    """df (html and others) with 87 html_ columns; null html counts as an empty page."""
    cols = text_columns("coalesce(html, '')") | tag_columns() | script_columns()
    return with_tags(df).selectExpr("*", *[f"{v} as {k}" for k, v in cols.items()]).drop("_tags", "_js")
