"""The nested record types."""

from __future__ import annotations

PARAM = "struct<name:string,type:string,required:boolean,description:string,default:string,in:string>"
EXAMPLE = "struct<language:string,code:string,label:string,sourceTab:string,snippetHash:string,exampleType:string>"
RESPONSE = "struct<statusCode:string,description:string,schema:string,example:string>"
HEADING = "struct<level:int,text:string,id:string>"
TABLE = "struct<headers:array<string>,rows:array<array<string>>,caption:string>"
ENDPOINT = (
    f"struct<method:string,path:string,summary:string,description:string,headers:array<{PARAM}>,queryParams:array<{PARAM}>,pathParams:array<{PARAM}>,bodyParams:array<{PARAM}>,"
    f"request:string,response:string,responses:array<{RESPONSE}>,authRequired:boolean,examples:array<{EXAMPLE}>,tags:array<string>>"
)
VISIBILITY = "struct<bodyParamsHeading:boolean,headersHeading:boolean,queryParamsHeading:boolean,responsesUi:boolean,tryItTablistCount:int>"
SNAPSHOT = (
    f"struct<pageTitle:string,description:string,breadcrumbs:array<string>,method:string,path:string,serverUrl:string,summary:string,bodyParams:array<{PARAM}>,headers:array<{PARAM}>,"
    f"queryParams:array<{PARAM}>,responses:array<{RESPONSE}>,tryItSamples:array<{EXAMPLE}>,sectionVisibility:{VISIBILITY}>"
)
SIGNALS = "struct<domExtraction:boolean,domSourceOfTruth:boolean,bodyParamCount:int,headerCount:int,responseCount:int,tryItLanguageCount:int,domViolations:array<string>>"
NAV = "url string, title string, slug string, domain string, depth int, `order` int, parentSlug string, navPath array<string>, pathTitles array<string>, ord long"
DOCUMENT = (
    f"id string, title string, domain string, subcategory string, storageSegments array<string>, type string, url string, content string, markdown string, description string, headings array<{HEADING}>, "
    f"tables array<{TABLE}>, examples array<{EXAMPLE}>, codeBlocks array<{EXAMPLE}>, breadcrumbs array<string>, tags array<string>, endpoint {ENDPOINT}, version string, authRequired boolean, contentHash string, "
    f"framework string, extractionQuality string, extractionSignals {SIGNALS}"
)
DOCUMENT_TYPES = ("overview", "guide", "endpoint", "auth", "webhook", "schema", "changelog", "concept", "reference", "unknown")
API_CALL = "url string, method string, resourceType string, headers map<string,string>, requestBody string, responseBody string, status int, timestamp string"
CHUNK = "id string, domain string, section string, type string, embedding_hint string, content string, metadata map<string,string>, sourceUrl string, documentId string"
