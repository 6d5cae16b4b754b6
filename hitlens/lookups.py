"""Word lists, patterns, thresholds and lookup tables that decide results."""

# --- fixed values: client platform, first match wins, on the lower-cased user agent
PLATFORM = [
    ("iOS_SDK", r"(wst-sdk-ios|zgt-ios/)"),
    ("Android_SDK", r"(wst-sdk-android|zgt-android/)"),
    ("Java_SDK", r"(wst-sdk-java)"),
    ("Android", r"android \d+\.|android;|linux.*android|dalvik.*android"),
    ("iOS", r"iphone os|ipad|ipod|cpu os.*like mac os x|ios \d+\.|cfnetwork.*darwin"),
    ("macOS", r"macintosh.*mac os x|macos"),
    ("Windows", r"windows nt \d+\.\d+"),
    ("Bot/Spider", r"(spider|bot|crawler|curl|wget)"),
    ("HTTP_Client", r"(okhttp|retrofit|volley|alamofire)"),
]

# --- fixed values: operating system
OPERATING_SYSTEM = [
    ("iOS_SDK", r"(wst-sdk-ios|zgt-ios/)"),
    ("Android_SDK", r"(wst-sdk-android|zgt-android/)"),
    ("Java_SDK", r"(wst-sdk-java)"),
    ("Windows 10", r"windows nt 10\.0"),
    ("Windows 8.1", r"windows nt 6\.3"),
    ("Windows 8", r"windows nt 6\.2"),
    ("Windows 7", r"windows nt 6\.1"),
    ("Windows Vista", r"windows nt 6\.0"),
    ("Windows XP", r"windows nt 5\.1"),
    ("macOS", r"macintosh.*mac os x|macos"),
    ("Android", r"android \d+\.|android;|linux.*android|dalvik.*android"),
    ("iOS", r"iphone os|ipad|ipod|cpu os.*like mac os x|ios \d+\.|cfnetwork.*darwin"),
    ("Bot/Spider", r"(spider|bot|crawler|curl|wget)"),
    ("HTTP_Client", r"(okhttp|retrofit|volley|alamofire)"),
    ("Development_Tool", r"(dart|flutter|postman)"),
    ("Ubuntu", r"ubuntu"),
    ("Linux", r"linux"),
]

# --- fixed values: browser name and version pattern (no group: no version)
BROWSER = [
    ("chrome", r"chrome/(\d+)"),
    ("firefox", r"firefox/(\d+)"),
    ("safari", r"safari/(\d+)"),
    ("edge", r"edge/(\d+)"),
    ("opera", r"opera/(\d+)"),
    ("internet explorer", r"msie (\d+)"),
    ("qq浏览器", r"qqbrowser/(\d+)"),
    ("搜狗浏览器", r"se 2\.x metasr"),
    ("360浏览器", r"360se|qhbrowser"),
    ("微信浏览器", r"micromessenger/(\d+)"),
    ("支付宝", r"alipayclient/(\d+)"),
    ("百度浏览器", r"baiduboxapp/(\d+)"),
    ("UC浏览器", r"ucbrowser/(\d+)"),
]

# --- fixed values: device and crawler families
DEVICE = [
    ("手机", r"mobile|phone|android|iphone"),
    ("平板", r"tablet|ipad"),
    ("智能电视", r"smart-tv|smarttv|television"),
    ("爬虫/机器人", r"bot|crawler|spider|scraper"),
]
BOT = [
    ("Googlebot", r"googlebot"),
    ("Baiduspider", r"baiduspider"),
    ("Bingbot", r"bingbot"),
    ("Yahoo爬虫", r"yahoo.*slurp"),
    ("搜狗爬虫", r"sogou.*spider"),
    ("360爬虫", r"360spider"),
    ("微信爬虫", r"wechatbot"),
    ("Facebook爬虫", r"facebookexternalhit"),
    ("Twitter爬虫", r"twitterbot"),
    ("其他爬虫", r"bot|crawler|spider|scraper"),
]
AGENT_FAMILY = [
    ("Hutool", "hutool"),
    ("WST-SDK", "wst-sdk"),
    ("Chrome", "chrome"),
    ("Firefox", "firefox"),
    ("Safari", "safari"),
    ("cURL", "curl"),
    ("wget", "wget"),
    ("Python", "python"),
    ("Java", "java"),
]
NO_BROWSER, OTHER_BROWSER = "未知浏览器", "其他浏览器"
NO_SYSTEM, OTHER_SYSTEM = "未知系统", "其他系统"
NO_DEVICE, DESKTOP = "未知设备", "桌面设备"

# --- fixed values: referer classes
SEARCH_ENGINE = [
    ("百度", r"baidu\.com"),
    ("Google", r"google\.com|google\.cn"),
    ("搜狗", r"sogou\.com"),
    ("360搜索", r"so\.com"),
    ("必应", r"bing\.com"),
    ("雅虎", r"yahoo\.com"),
    ("神马搜索", r"sm\.cn"),
    ("头条搜索", r"toutiao\.com"),
]
SOCIAL_NETWORK = [
    ("微信", r"weixin\.qq\.com"),
    ("微博", r"weibo\.com|t\.cn"),
    ("QQ空间", r"qzone\.qq\.com"),
    ("知乎", r"zhihu\.com"),
    ("豆瓣", r"douban\.com"),
    ("贴吧", r"tieba\.baidu\.com"),
    ("Facebook", r"facebook\.com"),
    ("Twitter", r"twitter\.com|t\.co"),
    ("LinkedIn", r"linkedin\.com"),
    ("Instagram", r"instagram\.com"),
]
DOMAIN_SEARCH = [
    ("Baidu", r"baidu\.com"),
    ("Google", r"google\.com"),
    ("Bing", r"bing\.com"),
    ("Sogou", r"sogou\.com"),
    ("360", r"so\.com"),
    ("Shenma", r"sm\.cn"),
]
DOMAIN_SOCIAL = [
    ("WeChat", r"weixin\.qq\.com"),
    ("Weibo", r"weibo\.com"),
    ("QQ", r"qq\.com"),
    ("Douyin", r"douyin\.com"),
    ("XiaoHongShu", r"xiaohongshu\.com"),
    ("Zhihu", r"zhihu\.com"),
]
SOCIAL_KIND = {
    "WeChat": "instant_message",
    "QQ": "instant_message",
    "Weibo": "social_network",
    "Douyin": "short_video",
    "XiaoHongShu": "social_commerce",
    "Zhihu": "knowledge_sharing",
}
SEARCH_PARAMETERS = ["q", "query", "wd", "keyword", "search"]
ENTRY_SOURCE = [
    ("Internal", r"wechat|weixin"),
    ("Search_Engine", r"baidu|google|bing"),
    ("Social_Media", r"weibo|qq|douyin"),
    ("Direct", r"-|direct"),
    ("External", r"http"),
]

# --- fixed values: request classes by URI
API_CATEGORY = [
    ("User_Auth", r"/api/.*/(login|auth|register|logout)"),
    ("Business_Core", r"/api/.*/order|/api/.*/payment|/api/.*/user"),
    ("System_Config", r"/api/.*/config|/api/.*/settings"),
    ("Third_Party", r"/api/.*/(third|external|gateway)"),
    ("Static_Resource", r"\.(css|js|png|jpg|gif|ico)$"),
]
STATIC_RESOURCE = r"(?i)\.(js|css|png|jpg|jpeg|gif|svg|ico|woff2?|ttf)$"
RESOURCE_TYPE = [
    ("javascript", r"\.(js|mjs)$"),
    ("stylesheet", r"\.css$"),
    ("image", r"\.(jpg|jpeg|png|gif|svg|ico|webp)$"),
    ("font", r"\.(woff|woff2|ttf|eot|otf)$"),
    ("media", r"\.(mp4|webm|ogg|mp3|wav)$"),
    ("document", r"\.(pdf|doc|docx|xls|xlsx)$"),
]
CONTENT_TYPE = [
    ("application/javascript", r"\.js$"),
    ("text/css", r"\.css$"),
    ("image/jpeg", r"\.(jpg|jpeg)$"),
    ("image/png", r"\.png$"),
    ("image/gif", r"\.gif$"),
    ("image/svg+xml", r"\.svg$"),
    ("application/json", r"\.json$|/api/|gateway"),
    ("text/html", r"\.(html|htm)$|^/$"),
]
ENDPOINT_TYPE = {
    "GET": "read",
    "POST": "create",
    "PUT": "update",
    "DELETE": "delete",
    "PATCH": "patch",
    "HEAD": "head",
    "OPTIONS": "options",
}
TRANSACTION_TYPE = {
    "GET": "query",
    "HEAD": "query",
    "OPTIONS": "query",
    "POST": "mutation",
    "PUT": "mutation",
    "PATCH": "mutation",
    "DELETE": "mutation",
}
OPERATION = [
    ("login", r"login|auth"),
    ("register", r"register|signup"),
    ("payment", r"payment|pay"),
    ("search", r"search|query"),
    ("upload", r"upload"),
    ("download", r"download"),
    ("create", r"create|add"),
    ("update", r"update|edit"),
    ("delete", r"delete|remove"),
    ("view", r"view|get"),
]
JOURNEY_STAGE = [
    ("discovery", r"^/$|home"),
    ("onboarding", r"register|signup"),
    ("authentication", r"login|auth"),
    ("exploration", r"search|browse"),
    ("consideration", r"product|detail"),
    ("conversion", r"cart|checkout"),
    ("transaction", r"payment|pay"),
    ("completion", r"success|complete"),
    ("retention", r"profile|account"),
]
# business domain: gateway services, then module words, then words anywhere in app/service/module
GATEWAY_APP, PORTAL_APP, STORE_APP = "scmp-gateway", "zgt-h5", "group1"
IDENTITY_SERVICE, PORTAL_SERVICE, PAY_SERVICE = "gxrz-rest", "zww", "alipay"
IDENTITY_DOMAIN = [
    ("government-authentication", r"login|auth|token|verify"),
    ("government-user-management", r"user"),
    ("government-account-binding", r"bind"),
]
PORTAL_DOMAIN = [
    ("government-query-service", r"query"),
    ("government-application-service", r"apply"),
]
GATEWAY_DOMAIN = {
    "alipay": "government-payment-service",
    "column": "government-content-service",
    "thirdSpecial": "government-integration-service",
    "weixinJsSdkSign": "government-wechat-service",
    "wechat": "government-wechat-service",
    "appKind": "government-app-config",
    "zgt-rest": "government-zgt-service",
}
H5_ASSETS = ["js", "css", "images", "fonts"]
WORD_DOMAIN = [
    ("government-certificate-service", r"certificate|license|permit|证照|许可"),
    ("government-social-security", r"social|insurance|社保|医保|养老"),
    ("government-taxation-service", r"tax|revenue|税务|纳税|发票"),
    ("government-household-service", r"household|residence|户口|户籍|居住"),
    ("government-housing-fund", r"fund|provident|公积金|住房"),
    ("government-transportation", r"traffic|vehicle|交通|车辆|驾驶"),
    ("user-service", r"user|account"),
    ("auth-service", r"auth|login"),
    ("payment-service", r"pay|order"),
    ("content-service", r"content|article"),
    ("file-service", r"file|upload"),
]
DOMAIN_BONUS = {
    "government-authentication": 30,
    "government-certificate-service": 25,
    "government-payment-service": 25,
    "government-social-security": 20,
    "government-taxation-service": 20,
}
CATEGORY_WEIGHT = {
    "auth": 85,
    "payment": 95,
    "gateway": 60,
    "webapp": 50,
    "storage": 40,
    "static": 20,
    "service": 50,
}
SERVICE_WORDS = r"(?i)gateway|service|api|rest"

# --- fixed values: network classes
TOR_PREFIXES = ["185.220.", "199.87.", "204.11.", "109.70.", "176.10."]
SUSPECT_PREFIXES = ["185.220.", "199.87.", "204.11."]
PROXY_PREFIXES = ["104.16.", "172.64.", "173.245.", "103.21.", "103.22."]
VPN_PREFIXES = ["45.", "91.", "194.", "195."]
DATACENTER_PREFIXES = ["13.", "52.", "104.", "142.250.", "157.240."]
INTERNAL_ADDRESS = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.|127\.)"
CARRIER_PREFIXES = [
    ("China Mobile", r"^(111|112|113|114|115|116|117|118|119|120)\."),
    ("China Telecom", r"^(221|222|223)\."),
    ("China Unicom", r"^(58|59|60|61)\."),
]
CARRIER_NETWORKS = [
    ("1.80.0.0/12", "China Telecom", "广东"),
    ("14.144.0.0/12", "China Telecom", "广东"),
    ("112.80.0.0/13", "China Unicom", "广西"),
    ("163.179.0.0/16", "China Unicom", "广西"),
    ("111.0.0.0/10", "China Mobile", "北京"),
    ("117.136.0.0/13", "China Mobile", "全国"),
    ("59.255.0.0/16", "Government Network", "政务专网"),
]
ENVIRONMENT = [("dev", r"dev|develop"), ("test", r"test|qa"), ("staging", r"staging|stage")]
TEAM = [
    ("guangxi_gov", r"gx|guangxi"),
    ("zhejiang_gov", r"zj|zhejiang"),
]
TENANT = [
    ("beijing_gov", r"beijing"),
    ("shanghai_gov", r"shanghai"),
    ("guangdong_gov", r"guangdong"),
    ("guangxi_gov", r"guangxi|gx"),
    ("zhejiang_gov", r"zhejiang|zj"),
    ("jiangsu_gov", r"jiangsu"),
    ("shandong_gov", r"shandong"),
    ("sichuan_gov", r"sichuan"),
    ("central_ministry", r"mof|moe|moh|mps"),
]
ENTRY_POINT = [
    ("gateway", r"gateway"),
    ("cdn", r"cdn"),
    ("proxy", r"proxy"),
    ("load_balancer", r"lb|load"),
]

# --- fixed values: status classes
ERROR_CATEGORY = {
    "400": "bad_request",
    "401": "unauthorized",
    "403": "forbidden",
    "404": "not_found",
    "429": "rate_limit",
    "500": "internal_error",
    "502": "gateway_error",
    "503": "service_unavailable",
    "504": "gateway_timeout",
}

# --- fixed values: attack patterns with scores, on lower-cased text
SQL_INJECTION = r"(\bunion\b.*\bselect\b|\bselect\b.*\bfrom\b|;.*\bdrop\b|\bor\b.*=.*\bor\b)"
CROSS_SITE = r"(<script|javascript:|onerror=|onload=)"
THREATS = [
    ("sql_injection", r"(\bunion\b.*\bselect\b|\bor\b.*=|\bdrop\b)", 50),
    ("xss", r"(<script|javascript:|onerror=)", 40),
    ("path_traversal", r"(\.\./|\.\.\\)", 40),
    ("sensitive_file", r"(\.env|\.git|web\.config|database\.yml)", 50),
    ("command_injection", r"(;|\||&&|`|\$\()", 30),
]
AGENT_RISK = [
    ("high_risk", r"sqlmap|nmap|nikto|dirb|gobuster|wfuzz|burp"),
    ("medium_risk", r"python|curl|wget|postman|script"),
    ("low_risk", r"googlebot|bingbot|baiduspider|bot|crawler"),
]
ATTACK_PATH = r"admin|\.php|sql|script"
GOVERNMENT_APPS = ["iGXRZ", "gxrz", "zwfw", "政务通", "市民云", "i深圳", "随申办"]

# --- fixed values: day periods, first hour NOT in the period
DAY_PERIOD = [
    (6, "Dawn"),
    (9, "EarlyMorning"),
    (12, "Morning"),
    (14, "Noon"),
    (17, "Afternoon"),
    (19, "EarlyEvening"),
    (22, "Evening"),
]
BUSINESS_PERIOD = [
    (6, "深夜/凌晨"),
    (9, "早高峰"),
    (12, "上午业务"),
    (14, "午休时段"),
    (18, "下午业务"),
    (21, "晚高峰"),
]

# --- fixed values: address blocks that count as private, and multicast
PRIVATE_NETWORKS = [
    "0.0.0.0/8",
    "10.0.0.0/8",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/29",
    "192.0.0.170/31",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "240.0.0.0/4",
]
MULTICAST_NETWORK = "224.0.0.0/4"

# --- fixed values: path classes of the second category scheme
PATH_CLASS = [
    ("API", r"^/api/"),
    ("Gateway_API", r"^/scmp-gateway/"),
    ("Static_Resource", r"^/(static|css|js)/"),
    ("File_Download", r"^/(group1|upload)/"),
    ("Health_Check", r"^/(health|status)$"),
    ("Image", r"\.(jpg|png|gif|ico|svg)$"),
    ("Asset", r"\.(css|js)$"),
]

# --- fixed values: compact scheme of client, referer and request classes
COMPACT_PLATFORM = [
    ("iOS_SDK", r"wst-sdk-ios|zgt-ios/|ios.*sdk|cfnetwork.*darwin|ios/\d+\.\d+"),
    ("Android_SDK", r"wst-sdk-android|zgt-android/|android.*sdk|okhttp|retrofit"),
    ("Java_SDK", r"wst-sdk-java|java.*sdk|apache-httpclient|java/\d+\.\d+"),
    ("iOS", r"iphone|ipad|ipod|ios \d+\.\d+|mobile/\w+|version/\d+\.\d+ mobile.*safari"),
    ("Android", r"android \d+\.\d+|android;|linux.*android|mobile.*chrome.*android|version.*mobile safari.*android"),
    ("macOS", r"macintosh.*mac os x|macos|darwin.*safari|version.*safari.*macintosh"),
    ("Windows", r"windows nt \d+\.\d+|windows \d+|win64|trident|msie|edge"),
    ("Web", r"chrome/\d+|firefox/\d+|safari/\d+|edge/\d+|opera/\d+"),
    ("Bot", r"bot|spider|crawler|curl|wget|facebookexternalhit|twitterbot|linkedinbot"),
]
COMPACT_DEVICE = [
    ("Mobile", r"iphone|android|mobile"),
    ("Tablet", r"ipad|tablet"),
    ("TV", r"tv|smart-tv"),
    ("Bot", r"bot|crawler|spider"),
]
COMPACT_SYSTEM = [
    ("Windows", r"windows"),
    ("macOS", r"mac os"),
    ("Android", r"android"),
    ("iOS", r"iphone|ipad"),
    ("Linux", r"linux"),
]
COMPACT_BOT = [
    ("Search Engine", r"googlebot|bingbot|baiduspider|yandexbot"),
    ("Social Media", r"facebookexternalhit|twitterbot|linkedinbot"),
    ("Monitoring", r"pingdom|uptimerobot|nagios"),
    ("Generic", r"bot|spider|crawler"),
]
COMPACT_ENTRY = [
    ("Search_Engine", r"google|baidu|bing|yahoo"),
    ("Social_Media", r"weibo|qq|wechat|douyin|facebook|twitter"),
    ("Internal", r"wechat|weixin"),
]
COMPACT_SEARCH = [("Google", r"google"), ("Baidu", r"baidu"), ("Bing", r"bing"), ("Yahoo", r"yahoo")]
COMPACT_SOCIAL = [
    ("WeChat", r"weixin|wechat"),
    ("Weibo", r"weibo"),
    ("QQ", r"qq\.com|qzone"),
    ("Douyin", r"douyin|tiktok"),
    ("Facebook", r"facebook"),
    ("Twitter", r"twitter|t\.co"),
]
COMPACT_CATEGORY = [
    ("User_Auth", r"/api/.*/auth|/api/.*/login|/api/.*/register|/api/.*/logout|/oauth|/sso"),
    ("Business_Core", r"/api/.*/order|/api/.*/payment|/api/.*/business|/api/.*/transaction|/api/.*/core"),
    ("System_Config", r"/api/.*/config|/api/.*/settings|/api/.*/admin|/api/.*/system|/api/.*/management"),
    ("Data_Query", r"/api/.*/query|/api/.*/search|/api/.*/list|/api/.*/get|/api/.*/find"),
    ("File_Upload", r"/api/.*/upload|/api/.*/file|/api/.*/attachment|/api/.*/media|/api/.*/document"),
    (
        "Static_Resource",
        r"\.(css|js|png|jpg|jpeg|gif|ico|woff|woff2|ttf|svg|mp4|pdf)$|/static/|/assets/|/resources/",
    ),
    ("Health_Check", r"/health|/ping|/status|/heartbeat|/actuator|/metrics"),
]
# keyword scheme: keyword, category, module, importance
KEYWORD_CATEGORY = [
    ("login", "auth", "user", "Critical"),
    ("logout", "auth", "user", "High"),
    ("register", "auth", "user", "Critical"),
    ("search", "search", "search", "High"),
    ("calendar", "calendar", "calendar", "Medium"),
    ("upload", "file", "upload", "High"),
    ("download", "file", "download", "Medium"),
    ("gxrz", "gxrz", "gxrz", "High"),
    ("zgt", "zgt", "zgt", "High"),
    ("api", "api", "general", "Medium"),
    ("group", "static", "cdn", "Low"),
]
REGION_PREFIXES = {
    "北京": ["10.", "172.16.", "192.168.", "110.", "111."],
    "上海": ["121.", "180.", "221.", "222."],
    "广州": ["113.", "14.", "223.", "59."],
    "深圳": ["119.", "183.", "224.", "58."],
    "杭州": ["115.", "60.", "101.", "125."],
    "成都": ["118.", "61.", "171.", "182."],
}
ISP_PREFIXES = {
    "电信": ["202.", "218.", "222.", "61.", "180."],
    "联通": ["210.", "221.", "123.", "125.", "140."],
    "移动": ["211.", "223.", "183.", "117.", "139."],
    "教育网": ["202.112.", "166.111.", "219."],
    "广电网": ["117.", "183."],
}
CARRIER_RANGES = {
    "China Telecom": ["1.0.", "1.1.", "14.", "27.", "36.", "42.", "49.", "58.", "59.", "60.", "61."],
    "China Unicom": ["10.", "112.", "113.", "114.", "115.", "116.", "117.", "118.", "119.", "120.", "121."],
    "China Mobile": ["39.", "111.", "183.", "211.", "218.", "221.", "222."],
}
