"""Expected fuzzy matches of the derived header table, stated as fixed values.

Target, normalised header, expected name, difflib ratio, and whether the match
is one that could turn an identifier into a cleaned column.
"""

FUZZY = [
    ('raw', 'como te enterasta de campus diverso', '¿Cómo te enteraste de los servicios de Campus Diverso?', 0.7640449438202247, False),
    ('raw', 'como te enteraste de campus diverso', '¿Cómo te enteraste de los servicios de Campus Diverso?', 0.7865168539325843, False),
    ('raw', 'direccion de residencia', 'Barrio de residencia', 0.7906976744186046, True),
    ('raw', 'grupo poblacional', '¿A qué grupo poblacional perteneces?', 0.6415094339622641, False),
    ('raw', 'redes de apoyo (identifica ¿con quienes/que apoyos cuentas?)', 'Redes de apoyo (Identifica con quiénes o con qué apoyos cuentas)', 0.9193548387096774, False),
    ('raw', 'sede de la universidad del valle', '¿Perteneces a la Universidad del Valle?', 0.7887323943661971, False),
    ('raw', '¿cual es tu eps?', '¿Cuál es tu ocupación actual?', 0.6222222222222222, False),
    ('raw', '¿tienes eps?', '¿Con quién(es) vives?', 0.6060606060606061, False),
    ('cleaned', 'direccion de residencia', 'Barrio de residencia', 0.7906976744186046, True),
    ('cleaned', 'fecha de diligenciamiento', 'Fecha de nacimiento', 0.8181818181818182, False),
    ('cleaned', '¿cual es tu eps?', '¿Cuál es tu ocupación actual?', 0.6222222222222222, False),
    ('cleaned', '¿tienes eps?', '¿Con quién(es) vives?', 0.6060606060606061, False),
]
