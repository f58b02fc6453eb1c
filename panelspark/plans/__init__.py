"""Query plans over the driver tables: stand-in roles and the registry."""
