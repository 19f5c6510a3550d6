"""Published report rows of two validation runs.

Inputs and expected scores for the score functions.
"""

# (run, dimension) -> (category, real %, generated %)
CATEGORICAL = {
    ('raw', 'Synthesis Method'): [
        ('Solid-state synthesis', 45.373797187268686, 45.600307755750435),
        ('Commercialization', 19.91117690599556, 19.99853099503519),
        ('Hydrothermal synthesis', 17.468541820873426, 4.998564469255359),
        ('Sol–gel method', 8.882309400444116, 11.99293301740104),
        ('(unknown)', 4.58919319022946, 0.0),
        ('/', 2.146558105107328, 0.9980643652834661),
        ('Glycine method', 1.1843079200592153, 3.0020321176850744),
        ('Directional melt crystallization', 0.44411547002220575, 1.4008263578483986),
        ('Coprecipitation method', 0.0, 10.008509295931331),
        ('Coprecipitation', 0.0, 2.0002316258097066),
    ],
    ('compliant', 'Synthesis Method'): [
        ('Solid-state synthesis', 45.373797187268686, 45.60006998906157),
        ('Commercialization', 19.91117690599556, 19.99839944773927),
        ('Hydrothermal synthesis', 17.468541820873426, 4.9986343972282015),
        ('Sol–gel method', 8.882309400444116, 11.993070591506289),
        ('(unknown)', 4.58919319022946, 0.0),
        ('/', 2.146558105107328, 0.9980531440387787),
        ('Glycine method', 1.1843079200592153, 3.0020463639800625),
        ('Directional melt crystallization', 0.44411547002220575, 1.4008307164581744),
        ('Coprecipitation method', 0.0, 10.008642894458363),
        ('Coprecipitation', 0.0, 2.000252455529283),
    ],
    ('raw', 'Processing Route'): [
        ('dry pressing', 80.01480384900074, 80.3935885645957),
        ('3D printing', 6.7357512953367875, 0.0),
        ('isostatic pressing', 3.552923760177646, 3.000901978875688),
        ('tape casting', 2.516654330125833, 3.004427520596275),
        ('vacuum filtration', 2.3686158401184305, 0.0),
        ('spin coating', 0.8882309400444115, 0.0),
        ('/', 0.8142116950407106, 0.0),
        ('magnetron sputtering', 0.6661732050333087, 0.0),
        ('ultrasonic atomization', 0.5181347150259068, 0.0),
        ('metal-organic chemical vapor deposition', 0.44411547002220575, 0.0),
        ('cutting and polishing', 0.44411547002220575, 0.0),
        ('plasma spray deposition', 0.22205773501110287, 0.0),
        ('vapor deposition', 0.22205773501110287, 0.0),
        ('pulsed laser deposition', 0.1480384900074019, 0.0),
        ('RF sputtering', 0.1480384900074019, 2.997946771181576),
        ('ultrasonic spray pyrolysis', 0.07401924500370095, 0.0),
        ('chemical vapor deposition', 0.07401924500370095, 0.0),
        ('spray pyrolysis', 0.07401924500370095, 2.601203118751415),
        ('spark plasma sintering', 0.07401924500370095, 8.001932045999352),
    ],
    ('compliant', 'Processing Route'): [
        ('dry pressing', 80.01480384900074, 80.39307773432175),
        ('3D printing', 6.7357512953367875, 0.0),
        ('isostatic pressing', 3.552923760177646, 3.000877539631767),
        ('tape casting', 2.516654330125833, 3.0044226224899617),
        ('vacuum filtration', 2.3686158401184305, 0.0),
        ('spin coating', 0.8882309400444115, 0.0),
        ('/', 0.8142116950407106, 0.0),
        ('magnetron sputtering', 0.6661732050333087, 0.0),
        ('ultrasonic atomization', 0.5181347150259068, 0.0),
        ('metal-organic chemical vapor deposition', 0.44411547002220575, 0.0),
        ('cutting and polishing', 0.44411547002220575, 0.0),
        ('plasma spray deposition', 0.22205773501110287, 0.0),
        ('vapor deposition', 0.22205773501110287, 0.0),
        ('pulsed laser deposition', 0.1480384900074019, 0.0),
        ('RF sputtering', 0.1480384900074019, 2.9981458953402913),
        ('ultrasonic spray pyrolysis', 0.07401924500370095, 0.0),
        ('chemical vapor deposition', 0.07401924500370095, 0.0),
        ('spray pyrolysis', 0.07401924500370095, 2.6012063021920766),
        ('spark plasma sintering', 0.07401924500370095, 8.002269906024154),
    ],
    ('raw', 'Dopant Element'): [
        ('Y', 37.9021595416483, 34.094127948676075),
        ('Sc', 32.921992066989866, 31.156328223339624),
        ('Yb', 8.77038342882327, 10.598558823804781),
        ('Ce', 7.007492287351257, 4.683792787470999),
        ('Dy', 3.9665050683120318, 3.728117729442684),
        ('Bi', 3.1732040546496254, 3.7214225776437058),
        ('Er', 1.4103129131776113, 1.883909209594445),
        ('Al', 0.7492287351256061, 0.6307449832493439),
        ('Gd', 0.6610841780520054, 2.503316524554137),
        ('Fe', 0.617011899515205, 0.6320074586902431),
        ('Ca', 0.5288673424416042, 1.2573642742552844),
        ('Si', 0.4407227853680035, 0.19137368282339903),
        ('Pr', 0.3966505068312032, 1.2590508911757061),
        ('Mn', 0.2644336712208021, 0.6317037524456469),
        ('In', 0.2644336712208021, 0.3791981916366715),
        ('Lu', 0.2644336712208021, 1.2572574534382197),
        ('Eu', 0.2644336712208021, 0.3803130030069222),
        ('Nb', 0.17628911414720141, 0.19008031312658394),
        ('Ti', 0.17628911414720141, 0.19075998675673211),
        ('Zn', 0.044072278536800354, 0.6305721848687977),
    ],
    ('compliant', 'Dopant Element'): [
        ('Y', 37.9021595416483, 34.09504392718034),
        ('Sc', 32.921992066989866, 31.15437762966968),
        ('Yb', 8.77038342882327, 10.598910497885015),
        ('Ce', 7.007492287351257, 4.683922990598084),
        ('Dy', 3.9665050683120318, 3.728269689566373),
        ('Bi', 3.1732040546496254, 3.721533784660781),
        ('Er', 1.4103129131776113, 1.8839828015375772),
        ('Al', 0.7492287351256061, 0.6307682960672087),
        ('Gd', 0.6610841780520054, 2.5034011790069637),
        ('Fe', 0.617011899515205, 0.6319910542071882),
        ('Ca', 0.5288673424416042, 1.2574064450466151),
        ('Si', 0.4407227853680035, 0.19138128635015136),
        ('Pr', 0.3966505068312032, 1.2590758895649254),
        ('Mn', 0.2644336712208021, 0.6316904704074674),
        ('In', 0.2644336712208021, 0.37921002827990835),
        ('Lu', 0.2644336712208021, 1.2572723867666002),
        ('Eu', 0.2644336712208021, 0.38032543506284466),
        ('Nb', 0.17628911414720141, 0.19008730974891397),
        ('Ti', 0.17628911414720141, 0.1907638851308641),
        ('Zn', 0.044072278536800354, 0.6305850132625008),
    ],
    ('raw', 'Crystal Phase (Major)'): [
        ('1', 86.88906128782001, 53.01172033792098),
        ('3', 6.904577191621413, 9.263578475211279),
        ('2', 6.2063615205585725, 31.29475010775145),
        ('4', 0.0, 2.32990224185232),
        ('5', 0.0, 4.1000488372639685),
    ],
    ('compliant', 'Crystal Phase (Major)'): [
        ('1', 86.88906128782001, 53.00868418063372),
        ('3', 6.904577191621413, 9.264157066826522),
        ('2', 6.2063615205585725, 31.296776830847733),
        ('4', 0.0, 2.3300583582940657),
        ('5', 0.0, 4.100323563397949),
    ],
}

# (run, dimension) -> statistic -> (real, generated)
NUMERICAL = {
    ('compliant', 'log10(Conductivity)'): {
        'Count': (1351.0, 113960665.0),
        'Mean': (-2.1133253358975024, -2.4390685100075093),
        'Std': (0.9583954756409012, 1.3060989478251723),
        'Min': (-7.01, -8.0),
        'P5': (-3.8710944004010948, -5.059665403204973),
        'P10': (-3.4518641077313896, -4.269120375390936),
        'P25': (-2.623127397353751, -3.123430435155871),
        'P50': (-1.945216803804912, -2.1767375251043055),
        'P75': (-1.431798275933005, -1.4827719508708153),
        'P90': (-1.0341400631929283, -1.0247184813257797),
        'P95': (-0.8675290767460953, -0.7925035329259812),
        'Max': (-0.019996628416253676, 0.0),
        'Pct_RMSE': (0.08364297901787691, 0.08364297901787691),
        'Std_Ratio': (0.7337847390787325, 0.7337847390787325),
    },
    ('raw', 'log10(Conductivity)'): {
        'Count': (1351.0, 113968301.0),
        'Mean': (-2.1133253358975024, -2.438906998840805),
        'Std': (0.9583954756409012, 1.3062069172317734),
        'Min': (-7.01, -8.0),
        'P5': (-3.8710944004010948, -5.059665403204973),
        'P10': (-3.4518641077313896, -4.269120375390936),
        'P25': (-2.623127397353751, -3.1232457486302705),
        'P50': (-1.945216803804912, -2.1765907159694122),
        'P75': (-1.431798275933005, -1.482614803875736),
        'P90': (-1.0341400631929283, -1.0245119357806078),
        'P95': (-0.8675290767460953, -0.7921592508349722),
        'Max': (-0.019996628416253676, 0.0),
        'Pct_RMSE': (0.08363925607745848, 0.08363925607745848),
        'Std_Ratio': (0.7337240853631488, 0.7337240853631488),
    },
    ('compliant', 'Operating Temperature'): {
        'Count': (1351.0, 113960665.0),
        'Mean': (726.0264108068097, 711.3070118623825),
        'Std': (165.37716759145619, 187.5753999745525),
        'Min': (290.0, 300.0),
        'P5': (500.0, 389.0),
        'P10': (530.0, 454.0),
        'P25': (600.0, 578.0),
        'P50': (700.0, 717.0),
        'P75': (800.0, 849.0),
        'P90': (1000.0, 951.0),
        'P95': (1000.0, 1007.0),
        'Max': (1400.0, 1363.0),
        'Pct_RMSE': (0.05244384171797789, 0.05244384171797789),
        'Std_Ratio': (0.881657016932349, 0.881657016932349),
    },
    ('raw', 'Operating Temperature'): {
        'Count': (1351.0, 113968301.0),
        'Mean': (726.0264108068097, 711.3389490381189),
        'Std': (165.37716759145619, 187.611021898496),
        'Min': (290.0, 300.0),
        'P5': (500.0, 389.0),
        'P10': (530.0, 454.0),
        'P25': (600.0, 578.0),
        'P50': (700.0, 717.0),
        'P75': (800.0, 849.0),
        'P90': (1000.0, 951.0),
        'P95': (1000.0, 1007.0),
        'Max': (1400.0, 1363.0),
        'Pct_RMSE': (0.05244384171797789, 0.05244384171797789),
        'Std_Ratio': (0.8814896156843648, 0.8814896156843648),
    },
    ('compliant', 'Dopant Molar Fraction'): {
        'Count': (2269.0, 190961722.0),
        'Mean': (0.09325182899956225, 0.060853538349865996),
        'Std': (0.8658485942416928, 0.0418966664498327),
        'Min': (0.001, 0.001),
        'P5': (0.01, 0.0082),
        'P10': (0.02, 0.0124),
        'P25': (0.03, 0.0236),
        'P50': (0.06, 0.0527),
        'P75': (0.08, 0.0944),
        'P90': (0.1, 0.12),
        'P95': (0.11, 0.1337),
        'Max': (35.0, 0.2),
        'Pct_RMSE': (0.0003929963653166178, 0.0003929963653166178),
        'Std_Ratio': (0.04838798229674976, 0.04838798229674976),
    },
    ('raw', 'Dopant Molar Fraction'): {
        'Count': (2269.0, 190974012.0),
        'Mean': (0.09325182899956225, 0.06085423703823185),
        'Std': (0.8658485942416928, 0.04189673394834112),
        'Min': (0.001, 0.001),
        'P5': (0.01, 0.0082),
        'P10': (0.02, 0.0124),
        'P25': (0.03, 0.0236),
        'P50': (0.06, 0.0527),
        'P75': (0.08, 0.0944),
        'P90': (0.1, 0.12),
        'P95': (0.11, 0.1337),
        'Max': (35.0, 0.2),
        'Pct_RMSE': (0.0003929963653166178, 0.0003929963653166178),
        'Std_Ratio': (0.04838806025322953, 0.04838806025322953),
    },
    ('compliant', 'Sintering Temperature'): {
        'Count': (1310.0, 114959453.0),
        'Mean': (1417.5916030534352, 1425.7479849873678),
        'Std': (147.15957597224607, 133.01441635188903),
        'Min': (425.0, 1000.0),
        'P5': (1100.0, 1200.0),
        'P10': (1200.0, 1250.0),
        'P25': (1400.0, 1350.0),
        'P50': (1400.0, 1450.0),
        'P75': (1500.0, 1510.0),
        'P90': (1600.0, 1600.0),
        'P95': (1600.0, 1650.0),
        'Max': (1800.0, 1650.0),
        'Pct_RMSE': (0.03897142718651647, 0.03897142718651647),
        'Std_Ratio': (0.9038787688337401, 0.9038787688337401),
    },
    ('raw', 'Sintering Temperature'): {
        'Count': (1310.0, 114967369.0),
        'Mean': (1417.5916030534352, 1425.7500317329173),
        'Std': (147.15957597224607, 133.0130814622506),
        'Min': (425.0, 1000.0),
        'P5': (1100.0, 1200.0),
        'P10': (1200.0, 1250.0),
        'P25': (1400.0, 1350.0),
        'P50': (1400.0, 1450.0),
        'P75': (1500.0, 1510.0),
        'P90': (1600.0, 1600.0),
        'P95': (1600.0, 1650.0),
        'Max': (1800.0, 1650.0),
        'Pct_RMSE': (0.03897142718651647, 0.03897142718651647),
        'Std_Ratio': (0.9038696977989155, 0.9038696977989155),
    },
}

# run -> (element, real, generated)
CORRELATION = {
    'raw': [
        ('Sc', -1.5380818756245362, -1.307631071459638),
        ('Pr', -2.3613596756936754, -2.7385810387393557),
        ('Ce', -1.5146850788779511, -2.120411998112104),
        ('Dy', -1.765199448861762, -2.2372959542474313),
        ('Bi', -1.4871625962862163, -2.6388196607250856),
        ('Y', -1.8322113498144275, -1.9924186339905514),
        ('Lu', -0.8598936970468796, -1.4305306998946508),
        ('Yb', -2.5684238076899235, -1.7316987109753488),
        ('Ca', -2.236208952559957, -2.4090815954571907),
    ],
    'compliant': [
        ('Sc', -1.5380818756245362, -1.3076302955239836),
        ('Pr', -2.3613596756936754, -2.7385810387393565),
        ('Ce', -1.5146850788779511, -2.1204119981121035),
        ('Dy', -1.765199448861762, -2.2372959542474318),
        ('Bi', -1.4871625962862163, -2.6388196607250856),
        ('Y', -1.8322113498144275, -1.9924184861380403),
        ('Lu', -0.8598936970468796, -1.4305306998946512),
        ('Yb', -2.5684238076899235, -1.7316987109753492),
        ('Ca', -2.236208952559957, -2.4090815954571907),
    ],
}

# (run, dimension) -> (score, weight, grade)
SUMMARY = {
    ('compliant', 'Synthesis Method'): (0.8825221129602756, 0.15, 'GOOD'),
    ('raw', 'Synthesis Method'): (0.8825226951359989, 0.15, 'GOOD'),
    ('compliant', 'Processing Route'): (0.8718721676437372, 0.1, 'GOOD'),
    ('raw', 'Processing Route'): (0.871874780002869, 0.1, 'GOOD'),
    ('compliant', 'Dopant Element'): (0.9835843887491135, 0.15, 'EXCELLENT'),
    ('raw', 'Dopant Element'): (0.983585068717629, 0.15, 'EXCELLENT'),
    ('compliant', 'Crystal Phase (Major)'): (0.8705712805578834, 0.1, 'GOOD'),
    ('raw', 'Crystal Phase (Major)'): (0.8705875649639947, 0.1, 'GOOD'),
    ('compliant', 'log10(Conductivity)'): (0.7682388115930227, 0.2, 'GOOD'),
    ('raw', 'log10(Conductivity)'): (0.7682472457554316, 0.2, 'GOOD'),
    ('compliant', 'Operating Temperature'): (0.8739760564322571, 0.1, 'GOOD'),
    ('raw', 'Operating Temperature'): (0.8739598395208962, 0.1, 'GOOD'),
    ('compliant', 'Dopant Molar Fraction'): (0.8084147878644956, 0.1, 'GOOD'),
    ('raw', 'Dopant Molar Fraction'): (0.8084148154336486, 0.1, 'GOOD'),
    ('compliant', 'Sintering Temperature'): (0.9070680363507568, 0.05, 'EXCELLENT'),
    ('raw', 'Sintering Temperature'): (0.9070653290184614, 0.05, 'EXCELLENT'),
    ('compliant', 'Dopant-Conductivity Correlation'): (0.5029280758506336, 0.05, 'POOR'),
    ('raw', 'Dopant-Conductivity Correlation'): (0.5029280999831709, 0.05, 'POOR'),
}

OVERALL = {"compliant": (0.8465469724349198, "GOOD"), "raw": (0.846548985171353, "GOOD")}

# (total checked, violations) -> pass rate
PASS_RATES = [(113968301, 7569, 99.99335867962093), (113968301, 67, 99.99994121172342), (190974012, 0, 100.0)]
