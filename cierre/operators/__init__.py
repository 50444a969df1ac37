"""Report operators (survey 2.10): dims (R1-R8), kpis (R9-R14),
funnel (R15-R20, R25), sla (R21-R22), verdict (R23-R24), qa (R26-R29)."""
