from contrail.sinks.tables import (  # noqa: F401
    expire_flight_events, expire_partitions, expire_state_vectors, reset_derived, retained,
    upsert, upsert_flight_events, upsert_state_vectors, write_airports,
)
