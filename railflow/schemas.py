"""Fixed schemas.  No schema is ever inferred (inference fails on all-null
batches and differs between weeks)."""

# Timetable XML as read by ``from_xml``: attributes carry a ``_`` prefix,
# repeated ``s`` elements become an array.  A corrupt-record column is not
# part of the schema (it stops ``from_xml`` from filling ``s``); malformed
# documents are recognised by a missing root ``station`` attribute.
STOP_EVENT_PLANNED = "struct<_pt:string,_ppth:string,_pp:string,_cs:string,_clt:string>"
STOP_EVENT_CHANGE = "struct<_ct:string,_cp:string,_cs:string,_clt:string>"
TRIP_LABEL = "struct<_f:string,_t:string,_o:string,_c:string,_n:string>"

PLANNED_STOP = f"struct<_id:string,tl:{TRIP_LABEL},ar:{STOP_EVENT_PLANNED},dp:{STOP_EVENT_PLANNED}>"
CHANGE_STOP = f"struct<_id:string,ar:{STOP_EVENT_CHANGE},dp:{STOP_EVENT_CHANGE}>"

PLANNED_XML_SCHEMA = f"_station string, _eva string, s array<{PLANNED_STOP}>"
CHANGE_XML_SCHEMA = f"_station string, _eva string, s array<{CHANGE_STOP}>"

# Fact table of the Parquet path, column order as stored (partition columns
# first, as written; they move to the end when read back partitioned).
MOVEMENT_COLUMNS = [
    "snapshot_date", "snapshot_hour", "snapshot_minute", "stop_id", "station_name",
    "filter_flags", "trip_type", "owner", "eva_number", "trip_category", "train_number",
    "origin_station", "destination_station", "planned_arrival_time", "planned_departure_time",
    "changed_arrival_time", "changed_departure_time", "arrival_delay_minutes",
    "departure_delay_minutes", "cancelled", "planned_platform", "changed_platform",
]

_coords = "struct<coordinates:array<double>>"
STATION_JSON_SCHEMA = (
    "result array<struct<"
    "number:string, ifopt:string, name:string,"
    "mailingAddress:struct<city:string,zipcode:string,street:string>,"
    "category:int, priceCategory:int,"
    "hasParking:boolean, hasBicycleParking:boolean, hasLocalPublicTransport:boolean,"
    "hasPublicFacilities:boolean, hasLockerSystem:boolean, hasTaxiRank:boolean,"
    "hasTravelNecessities:boolean, hasSteplessAccess:string, hasMobilityService:string,"
    "hasWiFi:boolean, hasTravelCenter:boolean, hasRailwayMission:boolean, hasDBLounge:boolean,"
    "hasLostAndFound:boolean, hasCarRental:boolean, federalState:string,"
    "regionalbereich:struct<number:int,name:string,shortName:string>,"
    "aufgabentraeger:struct<shortName:string,name:string>,"
    "timeTableOffice:struct<email:string,name:string>,"
    "szentrale:struct<number:int,publicPhoneNumber:string,name:string>,"
    "stationManagement:struct<number:int,name:string>,"
    f"evaNumbers:array<struct<number:int,geographicCoordinates:{_coords}>>,"
    "ril100Identifiers:array<struct<rilIdentifier:string,hasSteamPermission:boolean,"
    f"steamPermission:string,geographicCoordinates:{_coords},primaryLocationCode:string>>,"
    "productLine:struct<productLine:string,segment:string>"
    ">>"
)
