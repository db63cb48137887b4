"""Control tables: registry, watermarks, audit, and the loads they drive."""
