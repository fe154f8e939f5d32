"""Input schemas, as DDL, in one place (fixed values: the feeds' own field names)."""

from pyspark.sql.types import StructType

TRAFFIC_HISTORY_RAW = (
    "id string, fecha string, tipo_elem string, intensidad string, ocupacion string, "
    "carga string, vmed string, error string, periodo_integracion string"
)
TRAFFIC_LOCATIONS_RAW = "id string, nombre string, longitud string, latitud string"
TRAFFIC_LOCATIONS = "id int, name string, longitude double, latitude double, csv_index int"
TRAFFIC_XML = "idelem string, intensidad string, ocupacion string, carga string"

PARKING_REPLY = (
    "datetime string, data array<struct<id: int, name: string, freeParking: int, "
    "geometry: struct<type: string, coordinates: array<string>>>>"
)
PARKING_DETAIL_REPLY = "id int, data array<struct<features: array<struct<name: string, content: string>>>>"
PARKING_REGISTRY = "id int, latitude double, longitude double, name string, total_slots int"

BIKES_REPLY = (
    "datetime string, data array<struct<id: int, name: string, "
    "geometry: struct<coordinates: array<double>>, free_bases: int, total_bases: int, "
    "reservations_count: int, activate: int>>"
)

POI_REPLY = (
    "data array<struct<sourceName: string, data: array<struct<category: string, "
    "longitude: string, latitude: string, idPoi: string, name: string>>>>"
)
POI_REGISTRY = "category string, longitude double, latitude double, id int, name string"

BIKES_MESSAGE = (
    "id int, name string, active int, datetime timestamp, total_bases int, free_bases int, "
    "reservations int, longitude double, latitude double"
)
PARKING_MESSAGE = "datetime timestamp, id string, free_slots int"
TRAFFIC_MESSAGE = "id string, intensity string, occupancy string, load string"
OCCUPANCY_MESSAGE = "id string, occupancy double, longitude double, latitude double"

DEVICE_EVENT = (
    "customerId string, data struct<devices: array<struct<deviceId: string, measure: string, "
    "status: string, temperature: bigint>>>, eventId string, eventOffset bigint, "
    "eventPublisher string, eventTime string"
)

WORD_MESSAGE = "event_time string, data string"

BUS_TRIPS_RAW = (
    "trip_type string, trip_code string, company string, line_number string, origin string, "
    "destination string, year string, day string, trip_duration_hours string, "
    "delay_start_minutes string, delay_end_minutes string, travelled_distance_km string"
)

EMPLOYEE_RECORDS = (
    "first_name string, last_name string, job_title string, dob string, email string, phone string, "
    "salary double, department_id int"
)


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
