"""Record types of the known tables."""

from __future__ import annotations

PIPELINE = (
    "struct<expectedUrls:bigint,urlsFound:bigint,htmlScraped:bigint,htmlFailed:bigint,"
    "htmlBlocked:bigint,builds:bigint,mods:bigint>"
)
BLOCK_EVENTS = "array<struct<timestamp:timestamp,type:string,afterUrls:bigint>>"
SOURCE = (
    "id string, name string, url string, outputDir string, status string, priority int, attempted int, "
    f"lastAttempted timestamp, pipeline {PIPELINE}, blockEvents {BLOCK_EVENTS}, "
    "retryMetadata struct<attempts:int,lastAttempt:timestamp,lastMethod:string>"
)
URL = "url string, filename string"
PAGE = "build_id bigint, url string, html string, scraped_at timestamp, status_code int"
PROGRESS = "url string, filename string, status string, error string, timestamp timestamp"
MOD_ITEM = "struct<name:string,category:string,brand:string,part_number:string,details:string>"
SALE = (
    "struct<status:string,is_auction:boolean,price:string,price_numeric:double,listing_price:string,"
    "listing_price_numeric:double,currency:string,no_reserve:boolean,bid_count:int,auction_type:string,"
    "end_date:timestamp,vin:string,mileage:string,mileage_numeric:int,title_status:string,"
    "body_style:string,location:string,lot_number:string>"
)
WHEEL = "struct<diameter:string,width:string,offset:string,bolt_pattern:string>"
FITMENT = (
    f"struct<front_wheel:{WHEEL},rear_wheel:{WHEEL},front_tire:string,rear_tire:string,"
    "suspension_type:string,ride_height:string>"
)
BUILD = (
    "build_id bigint, source_type string, build_type string, build_source string, source_url string, "
    "build_title string, year string, make string, model string, trim string, generation string, engine string, "
    "transmission string, drivetrain string, exterior_color string, interior_color string, build_story string, "
    "owner_username string, vin string, build_nickname string, gallery_images array<string>, "
    f"modifications array<{MOD_ITEM}>, modification_level string, vehicle_summary_extracted string, "
    f"extraction_confidence double, sale_data {SALE}, wheel_and_tire_fitment_specs {FITMENT}, "
    "build_stats struct<horsepower:double,torque:double,weight:double,quarter_mile:string,top_speed:double>, "
    "metadata struct<era:string,category:string,highlights:array<string>,equipment:array<string>,"
    "published_date:timestamp,scraped_at:timestamp,"
    "scraper_metadata:struct<extractor:string,auction_id:string,page_type:string>>, "
    "processing struct<extracted_at:timestamp,extractor_version:string,model_used:string,source_scraped_at:timestamp>, "
    "last_updated timestamp, products array<struct<name:string,url:string,price:string,brand:string>>"
)
MOD = (
    "build_id bigint, source_url string, mod_name string, brand string, category string, "
    "is_tuner_package boolean, package_name string, confidence double"
)
LOG = "timestamp timestamp, level string, message string, data map<string,string>"
HTTP_EVENT = (
    "event_id string, run_id string, iteration_id string, timestamp timestamp, source_id string, stage string, "
    "method string, url string, url_domain string, url_path string, request_headers string, request_body binary, "
    "request_body_size bigint, request_body_compressed boolean, status_code int, response_headers string, "
    "response_body binary, response_body_size bigint, response_body_compressed boolean, duration_ms bigint, "
    "request_type string, is_navigation boolean, is_build_page boolean, is_blocked boolean, blocked_reason string, "
    "retry_attempt int, browser_session_id string, initiator string, error_type string, error_message string"
)
ENTITY = (
    "id string, type string, name string, observations array<string>, properties string, "
    "created_at timestamp, updated_at timestamp"
)
RELATION = "id string, from_id string, to_id string, relation_type string, properties string, created_at timestamp"
STORY = "struct<id:string,title:string,acceptanceCriteria:array<string>,priority:int,passes:boolean>"
