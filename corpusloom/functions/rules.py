"""Rule tables: the fixed values that results depend on, as data."""

from __future__ import annotations

# --- fixed values: named entities, decoded in this order ---
ENTITIES = (
    ("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("#39", "'"),
    ("ldquo", "“"), ("rdquo", "”"), ("lsquo", "‘"), ("rsquo", "’"),
    ("mdash", "—"), ("ndash", "–"), ("hellip", "…"), ("middot", "·"),
)

# --- fixed values: the narrower list for paragraphs ---
PARAGRAPH_ENTITIES = (("nbsp", " "), ("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"))

# --- fixed values: BBCode marks and what stands for them, in this order ---
BBCODE = (
    (r"(?i)\[h1(?:\s+[^\]]*)?\]", "\n\n## "), (r"(?i)\[/h1\]", "\n\n"), (r"(?i)\[h2(?:\s+[^\]]*)?\]", "\n\n### "), (r"(?i)\[/h2\]", "\n\n"),
    (r"(?i)\[h3(?:\s+[^\]]*)?\]", "\n\n#### "), (r"(?i)\[/h3\]", "\n\n"), (r"(?i)\[hr\]\s*\[/hr\]", "\n\n"), (r"(?i)\[/?list\]", "\n"), (r"\[\*\]", "\n- "),
    (r"(?i)\[/?(?:b|i|u|strike|code|quote|url|h[1-6]|list|hr)[^\]]*\]", ""),
)

# --- fixed values: where the article of a help page begins and ends ---
HELP_PURPOSE = "X's purpose is to serve the public conversation"
HELP_MONTH = r"^(January|February|March|April|May|June|July|August|September|October|November|December) \d{4}\z"
HELP_HEADING = r"(?i)^(Overview|Policy|What is|How we|When this applies|Examples|Safety|Privacy|Authenticity|Enforcement)"
HELP_CHALLENGE = r"(?i)Cloudflare|security verification|Just a moment"
HELP_END = "Share this article"
CONVENTION_PHRASE = "违法违禁"

# --- fixed values: what a bot challenge page shows within its first characters ---
CHALLENGE_WINDOW = 100_000
CHALLENGE = (r"<title>\s*Just a moment", r"security verification", r"challenges\.cloudflare\.com", r"\bcf_chl\b|__cf_chl")

# --- fixed values: tags that break lines ---
BLOCK_TAGS = "h[1-6]|p|div|section|article|header|footer|main|tr|table|ul|ol"
NOISE_TAGS = ("script", "style", "noscript", "svg")
PRE_LEAST = 500

# --- fixed values: where the main element of a host's pages is; kind is id, tag or class; tried in order ---
SCOPES = (
    ("uscode.house.gov", "id", "docViewer"),
    ("leginfo.legislature.ca.gov", "id", "display_code_many_law_sections"),
    ("leg.state.fl.us", "id", "statutes"),
    ("redditinc.com", "id", "main-content"),
    ("support.discord.com", "id", "main-content"),
    ("support.discord.com", "tag", "article"),
    ("discord.com", "id", "main"),
    ("discord.com", "tag", "main"),
    ("trust.douyin.com", "class", r"\barticle-wrapper\b"),
    ("kuaishou.com", "class", r"\bnorm-content\b"),
    ("zhihu.com", "class", r"\bztext\b"),
    ("zhihu.com", "tag", "main"),
    ("linkedin.com", "tag", "main"), ("linkedin.com", "tag", "article"),
    ("policy.pinterest.com", "tag", "main"), ("policy.pinterest.com", "tag", "article"),
    ("values.snap.com", "tag", "main"), ("values.snap.com", "tag", "article"),
    ("tiktok.com", "tag", "main"), ("tiktok.com", "tag", "article"),
    ("support.tiktok.com", "tag", "main"), ("support.tiktok.com", "tag", "article"),
    ("douyin.com", "tag", "main"), ("douyin.com", "tag", "article"),
)
#: Hosts whose pages are empty while the main element is missing or a skeleton.
SKELETONS = (("trust.douyin.com", "semi-skeleton"),)
#: Hosts whose main element ends before a text.
CUT_BEFORE = (("support.discord.com", "Related articles"), ("support.discord.com", "Recently viewed articles"))
COMMUNITIES_PHRASE = "Reddit is a vast network of communities"
CHROME_TAGS = ("header", "footer", "nav", "aside")
HIDDEN_CLASSES = "archived-link|sr-only|visually-hidden|w-condition-invisible|w-dyn-bind-empty"

# --- fixed values: lines at which the page's own text is over; the host "" stands for all ---
CHROME_STARTS = (
    ("", r"(?iu)^(Related articles|Recently viewed articles|Share this article)\z"),
    ("", r"(?iu)^Powered by\z"),
    ("transparency.meta.com", r"^Data\z"),
    ("transparency.meta.com", r"^\[Enforcement\]\(https://transparency\.meta\.com/enforcement/\)\z"),
    ("discord.com", r"^Tags\z"),
    ("support.tiktok.com", r"^Helpful links\z"),
    ("support.tiktok.com", r"^TikTok monetization and advertising policies\z"),
    ("douyin.com", r"^抖音生活服务-学习中心\z"),
    ("douyin.com", r"^抖音游戏厂商合作平台\z"),
    ("douyin.com", r"^扫码登录\z"),
    ("douyin.com", r"^2026 © 抖音\z"),
    ("weixin.qq.com", r"^关于腾讯 \| 微信安全 \|"),
    ("weixin.qq.com", r"^Copyright &copy; 1998-2026 Tencent All Rights Reserved\.\z"),
    ("leginfo.legislature.ca.gov", r"^[A-Z]{2,4} .+ - [A-Z]{2,4}\z"),
    ("codes.ohio.gov", r"^Last updated "),
)
# --- fixed values: lines that are never text ---
CHROME_LINES = (
    ("", r"(?iu)^(Skip to main content|Was this helpful\?|Was it helpful\?)\z"),
    ("", r"(?iu)^\[Log in\]\(https://www\.tumblr\.com/login\) \[Sign up\]\(https://www\.tumblr\.com/register\)\z"),
    ("support.google.com", r"(?iu)^Subscribe to the \[YouTube (?:Creators|Viewers) channel\]"),
    ("tumblr.com", r"^Tumblr\z"),
    ("discord.com", r"^\[[^\]]+\]\(https://discord\.com/[^)]*\) >\z"),
    ("support.tiktok.com", r"^TikTok Support\z"),
)
# --- fixed values: pages of no value: host, path that must occur, path that must not, most lines ---
LOW_VALUE = (
    ("tiktok.com", r"^/legal/report/", None, None),
    ("%tiktok.com", None, "/community-guidelines", 2),
    ("support.tiktok.com", None, None, 0),
)

# --- fixed values: stamps, page numbers and bill numbers in text taken from PDF ---
PDF_LINES = (
    r"^\*?[A-Z]{2,}\d+\*?\s+\d{2}-\d{2}-\d{4}\s+\d{2}:\d{2}:\d{2}\s+[A-Z]+\d+\z",
    r"^\d+\s+\d{2}-\d{2}-\d{4}\s+\d{2}:\d{2}:\d{2}\s+[A-Z]+\d+\z",
    r"(?i)^As Engrossed: .* SB\d+\z",
    r"^Page \d+\z",
    r"(?i)^HB\d+\z",
    r"^\d{6}\z",
    r"^-\d+-\z",
    r"^-\d+-\s+\d+\z",
)

# --- fixed values: keys of document metadata and the fields they fill ---
METADATA_KEYS = {
    "Collection": "collection", "Jurisdiction": "jurisdiction", "Scope Note": "scope_note", "Source Authority": "source_authority",
    "Source URL": "source_urls", "Reference URL": "reference_urls", "Retrieval Date": "retrieval_date", "Language": "language",
    "Language Group": "language_group", "Fetch Method": "fetch_method", "Extractor": "extractor", "Extraction Status": "extraction_status",
    "Status Note": "status_note", "司法辖区": "jurisdiction", "文件类型": "document_type", "发布机关": "issuing_authority",
    "公布日期": "publication_date", "修订记录": "revision_history", "现行文本来源": "source_authority", "来源链接": "source_urls",
    "抓取日期": "retrieval_date", "语言组": "language_group", "生成方式": "generation_method", "说明": "status_note",
}
NOT_RULES = ("README.md", "README_cn.md", "risk-index.md", "risk-index_cn.md")

#: Hosts whose pages are narrowed to a part; all others are taken whole.
SCOPED_HOSTS = tuple(sorted({"redditinc.com", "douban.com", *(h for h, *_ in SCOPES), *(h for h, _ in SKELETONS), *(h for h, _ in CUT_BEFORE)}))

# --- fixed values: risk categories and their labels ---
RISK_LABELS = (
    ("illegal_activity", "Illegal activity", "违法活动"),
    ("child_safety", "Child safety and exploitation", "未成年人安全与剥削"),
    ("sexual_content", "Sexual content and nudity", "色情、性内容与裸露"),
    ("violence_threats", "Violence, threats, and dangerous acts", "暴力、威胁与危险行为"),
    ("hate_harassment", "Hate, harassment, and abuse", "仇恨、骚扰与攻击"),
    ("regulated_goods", "Regulated or prohibited goods and services", "受管制或禁止的商品与服务"),
    ("fraud_scams", "Fraud, scams, and deceptive conduct", "欺诈、诈骗与误导行为"),
    ("privacy_doxxing", "Privacy, doxxing, and personal data abuse", "隐私、开盒与个人信息滥用"),
    ("misinformation", "Misinformation and manipulated media", "不实信息与操纵媒体"),
    ("self_harm", "Self-harm, suicide, and eating disorders", "自伤、自杀与进食障碍"),
    ("platform_integrity", "Platform integrity, spam, and manipulation", "平台秩序、垃圾信息与操纵"),
    ("intellectual_property", "Intellectual property", "知识产权"),
)

# --- fixed values: the pages of a platform group, by language, and what they are headed with ---
RISK_PAGES = {"en": "risk-index.md", "cn": "risk-index_cn.md"}
RISK_TITLES = {"en": ("Illegal and High-Risk Content Index", "Tagged Categories", "Official Sources"), "cn": ("违法和高风险内容类别索引", "已标记类别", "官方来源")}

# --- fixed values: references that lead to no page ---
NO_PAGES = ("mailto:", "tel:", "javascript:")

# --- fixed values: URLs that differ only behind the # and site aliases ---
HASH_ROUTED = ("bilibili.com/blackboard/help.html", "link.bilibili.com/p/eden/news")
POLICY_HOSTS = ("help.x.com", "help.twitter.com")
POLICY_FOLDER = "rules-and-policies"
POLICY_URL = "https://help.x.com/en/rules-and-policies/%s.html"
POLICY_WITHOUT_PAGE = "parody-account-policy"  # its address has no file extension
HELP_HOST = "support.google.com"
HELP_ID = r"^/youtube/answer/([0-9]+)"
